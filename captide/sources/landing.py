"""Scans of the landing area a fetcher fills: snapshots, captions, metadata, exit codes.

Every reader has an explicit schema and does its parsing in column expressions,
so the same parsing also applies to lines or texts held in a table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.functions import batches
from captide.functions.outcomes import compact_date, error_detail, first_filled, whole_number
from captide.schema import CAPTION_SUFFIX, DEFAULT_LANGUAGE, ID, METADATA_COLUMNS

FETCH_RESULT_SCHEMA = (
    "video_id string, returncode int, stderr string, seq long, caption_files array<string>"
)
EXIT_STATUS_SCHEMA = "returncode int, stderr string"

# Metadata file keys that are read; numbers are read as text.
_INFO_FIELDS = (
    "title",
    "channel",
    "uploader",
    "channel_id",
    "uploader_id",
    "upload_date",
    "duration",
    "view_count",
)
_INFO_SCHEMA = ", ".join(f"{name} string" for name in _INFO_FIELDS)
# The suffix of metadata files.
INFO_SUFFIX = ".info.json"

_CAPTION_NAME = r"^([^.]+)(?:\.(.*))?\.vtt$"


class IncompleteSnapshot(RuntimeError):
    """The snapshot listing did not finish, so absent ids must not be read as removed."""


def json_object(text: Column, fields: str, mode: str = "PERMISSIVE") -> Column:
    """The one JSON object a text holds, else null.

    Parsing it as the only element of an array makes trailing content malformed;
    a bare object parse would silently ignore it.
    """
    parsed = F.from_json(
        F.concat(F.lit("["), text, F.lit("]")),
        f"array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>",
        {"mode": mode, "allowSingleQuotes": "false"},
    )
    return F.when(F.size(parsed) == 1, parsed[0])


# Why a landed line, file or name is set aside.
BLANK, MALFORMED, NO_ID, NAME = "blank", "malformed", "no id", "name"


def snapshot_lines(lines: DataFrame) -> DataFrame:
    """``video_id, value, reason`` of JSON lines in ``value``; ``reason`` is null for those with an id."""
    parsed = json_object(F.col("value"), "id string")
    return lines.select("value", parsed.alias("parsed")).select(
        F.col("parsed.id").alias("video_id"),
        "value",
        F.when(F.trim("value") == "", BLANK)
        .when(F.col("parsed").isNull(), MALFORMED)
        .when(F.coalesce("parsed.id", F.lit("")) == "", NO_ID)
        .alias("reason"),
    )


def snapshot_ids(lines: DataFrame) -> DataFrame:
    """Ids from JSON lines in ``value``; blank, malformed and id-less lines are skipped."""
    return snapshot_lines(lines).where(F.col("reason").isNull()).select("video_id")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return snapshot_lines(spark.read.text(path))


def completeness(statuses: DataFrame) -> DataFrame:
    """One row on the recorded exit codes of a listing: it is complete if there are some, all zero."""
    finished = F.coalesce(F.col("returncode") == 0, F.lit(False))
    counts = statuses.agg(
        F.count("*").alias("listings"),
        F.count_if(~finished).alias("unfinished"),
        F.max("stderr").alias("stderr"),
    )
    return counts.withColumn("complete", (F.col("listings") > 0) & (F.col("unfinished") == 0))


def require_complete(spark: SparkSession, status_path: str) -> None:
    """Raise unless the listing's recorded exit code is zero, even if it left ids behind."""
    status = completeness(spark.read.schema(EXIT_STATUS_SCHEMA).json(status_path)).first()
    if not status.complete:
        raise IncompleteSnapshot(f"snapshot listing did not finish: {status.asDict()}")


def caption_name(file_name: Column) -> Column:
    """Video id and language from ``<id>.<language>.vtt``."""
    language = F.regexp_extract(file_name, _CAPTION_NAME, 2)
    return F.struct(
        F.regexp_extract(file_name, _CAPTION_NAME, 1).alias("video_id"),
        F.coalesce(F.nullif(language, F.lit("")), F.lit(DEFAULT_LANGUAGE)).alias("source_language"),
    )


def caption_names(files: DataFrame) -> DataFrame:
    """``video_id, source_language, name, file`` from ``name, file``; the id of an odd name is empty."""
    return files.select(caption_name(F.col("name")).alias("n"), "name", "file").select(
        "n.video_id", "n.source_language", "name", "file"
    )


def list_captions(spark: SparkSession, path: str) -> DataFrame:
    """The landed caption files by name; none is opened.

    File sources do not list zero-byte files; ``empty_captions`` adds those that the
    fetcher names.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{CAPTION_SUFFIX}").load(path)
    return caption_names(files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("path").alias("file")))


def read_texts(chosen: DataFrame) -> DataFrame:
    """``chosen`` with ``raw_vtt``, the text of its ``file``, line ends read as newlines.

    Tasks open the chosen files and no other, one at a time; a null file is an empty text.
    """
    columns = chosen.columns
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema] + ["raw_vtt string"])
    at = columns.index("file")

    def run(batches_):
        return batches.with_texts(batches_, at)

    # Names are small and texts are not: as many tasks as there are places to run them.
    dealt = chosen.repartition(max(chosen.sparkSession.sparkContext.defaultParallelism, 1), "file")
    return dealt.mapInArrow(run, schema)


def read_captions(spark: SparkSession, path: str) -> DataFrame:
    """``video_id, source_language, raw_vtt`` of the landed caption files that have content."""
    return read_texts(list_captions(spark, path)).select("video_id", "source_language", "raw_vtt")


def joined_texts(chosen: DataFrame, texts: DataFrame) -> DataFrame:
    """``chosen`` with ``raw_vtt`` from ``file, raw_vtt`` rows; a null file is an empty text.

    ``chosen`` is staged, so its size is known and a small one is broadcast; beyond that
    a filter of its files is made at run time and applied to the texts as they are read.
    """
    named = chosen.where(F.col("file") != "").join(texts, "file")
    empty = chosen.where(F.col("file").isNull()).withColumn("raw_vtt", F.lit(""))
    return named.select(*chosen.columns, "raw_vtt").unionByName(empty)


def empty_captions(fetches: DataFrame) -> DataFrame:
    """One row per video for which the fetcher names caption files, its first language.

    Such a video has a caption even if no file of it has content.
    """
    languages = F.transform("caption_files", lambda name: caption_name(name)["source_language"])
    return (
        fetches.where(F.size("caption_files") > 0)
        .groupBy("video_id")
        .agg(F.min(F.array_min(languages)).alias("source_language"))
    )


def split_infos(texts: DataFrame) -> DataFrame:
    """``video_id, value`` rows of metadata JSON to table columns, with a ``reason`` where that fails.

    ``has_info`` is false for an empty object, which carries no metadata at all, and for
    a text that is set aside.
    """
    keys = F.json_object_keys("value")
    parsed = texts.select(
        "video_id", "value", keys.alias("keys"), json_object(F.col("value"), _INFO_SCHEMA).alias("info")
    )
    reason = F.when(F.trim("value") == "", BLANK).when(F.col("keys").isNull() | F.col("info").isNull(), MALFORMED)
    return parsed.select(
        "video_id",
        "value",
        reason.alias("reason"),
        F.coalesce(reason.isNull() & (F.size("keys") > 0), F.lit(False)).alias("has_info"),
        *info_columns(F.col("info")),
    )


def parse_infos(texts: DataFrame) -> DataFrame:
    """``split_infos`` without the texts that cannot be read."""
    return split_infos(texts).where(F.col("reason").isNull()).drop("value", "reason")


def info_columns(info: Column) -> list[Column]:
    """The six metadata columns from raw metadata fields."""
    columns = (
        info["title"],
        first_filled(info["channel"], info["uploader"]),
        first_filled(info["channel_id"], info["uploader_id"]),
        compact_date(info["upload_date"]),
        whole_number(info["duration"], "int"),
        whole_number(info["view_count"], "bigint"),
    )
    return [c.alias(name) for c, name in zip(columns, METADATA_COLUMNS, strict=True)]


def read_infos(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True, pathGlobFilter=f"*{INFO_SUFFIX}")
    name = F.col("_metadata.file_name")
    return split_infos(
        files.select(
            F.left(name, F.length(name) - len(INFO_SUFFIX)).alias("video_id"), F.col("value")
        )
    )


def read_fetch_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FETCH_RESULT_SCHEMA).json(path)


def rejected(source: str, rows: DataFrame) -> DataFrame:
    """``source, name, reason, sample`` of what could not be read, from ``video_id, value, reason``."""
    return rows.where(F.col("reason").isNotNull()).select(
        F.lit(source).alias("source"),
        F.col("video_id").alias("name"),
        "reason",
        error_detail(F.col("value")).alias("sample"),
    )


def rejected_names(names: DataFrame) -> DataFrame:
    """Caption files whose name does not start with an id, in the same form."""
    return names.where(~F.col("video_id").rlike(f"^{ID}$")).select(
        F.lit("captions").alias("source"), "name", F.lit(NAME).alias("reason"), F.col("file").alias("sample")
    )
