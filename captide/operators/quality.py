"""Audits: count parity, leftover markup, table constraints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captide.functions.text import is_blank
from captide.schema import FETCH_STATUSES, KEYS, PART, REQUIRED, SCHEMAS, VIDEOS

# Leftovers that must not appear in cleaned text.  Digits and white
# space are ASCII here, unlike in cleaning.
ARTIFACT_PATTERNS = {
    "webvtt_header": r"WEBVTT",
    "timestamp_arrow": r"[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}[\t\n\f\r ]*-->",
    "caption_tag": r"</?c>",
    "inline_timestamp": r"<[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]+>",
    "vtt_kind_header": r"Kind:",
}


class ConstraintViolation(RuntimeError):
    """New rows break a table constraint; nothing was committed."""


def with_leftovers(rows: DataFrame) -> DataFrame:
    """``full_text`` and per pattern whether it has a match, from one scan of each text.

    All patterns are one alternation.  No match of one overlaps a match of another, so
    none hides another, and what was found tells its pattern by its own letters.
    """
    anything = "|".join(f"(?:{p})" for p in ARTIFACT_PATTERNS.values())
    found = F.array_distinct(F.regexp_extract_all("full_text", F.lit(anything), F.lit(0)))
    scanned = rows.select("full_text", found.alias("found"))

    def hit(pattern: str) -> Column:
        return F.coalesce(F.exists("found", lambda match: match.rlike(f"^(?:{pattern})$")), F.lit(False))

    return scanned.select("full_text", *[hit(p).alias(name) for name, p in ARTIFACT_PATTERNS.items()])


def artifact_audit(silver: DataFrame) -> DataFrame:
    return with_leftovers(silver.select("full_text")).agg(
        F.count("*").alias("silver_count"),
        F.count_if(is_blank(F.col("full_text"))).alias("empty_silver"),
        *[F.count_if(name).alias(name) for name in ARTIFACT_PATTERNS],
    )


def table_counts(videos: DataFrame, bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """One row of counts and leftover hits, each table read once.

    The tables' single rows are stacked and summed, which needs no join.
    """
    parts = [
        bronze.agg(F.count("*").alias("bronze_count")),
        videos.agg(F.count_if(F.col("fetch_status") == "ok").alias("ok_videos_count")),
        artifact_audit(silver),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.sum(c).alias(c) for c in stacked.columns])


# The wording of report errors, here and in validation_report.
def _count_error(left: str, right: Column, label: str) -> Column:
    count = F.col(f"{left}_count")
    return F.when(count != right, F.format_string(f"{left} count (%d) != {label} (%d)", count, right))


def validation_report(videos: DataFrame, bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Status, counts, leftover hits and the list of errors, as one row."""
    ok = F.col("ok_videos_count")
    errors = [
        _count_error("silver", ok, "ok videos"),
        _count_error("bronze", ok, "ok videos"),
        F.when(
            F.col("empty_silver") > 0,
            F.format_string("%d silver row(s) have empty full_text", "empty_silver"),
        ),
        *[
            F.when(F.col(n) > 0, F.format_string(f"%d silver row(s) contain {n}", n))
            for n in ARTIFACT_PATTERNS
        ],
    ]
    counts = table_counts(videos, bronze, silver)
    return counts.select(
        *counts.columns, F.filter(F.array(*errors), lambda e: e.isNotNull()).alias("errors")
    ).withColumn("status", F.when(F.size("errors") == 0, "ok").otherwise("failed"))


def count_parity(videos: DataFrame, bronze: DataFrame, silver: DataFrame) -> DataFrame:
    ok = F.col("ok_videos_count")
    return table_counts(videos, bronze, silver).select(
        "bronze_count",
        "silver_count",
        "ok_videos_count",
        (F.col("silver_count") == ok).alias("silver_matches"),
        (F.col("bronze_count") == ok).alias("bronze_matches"),
    )


def constraint_audit(table: str, rows: DataFrame) -> DataFrame:
    """Violations of each key, null and value rule of a table: ``constraint, violations``."""
    keys = KEYS[table]
    checks = {f"not_null_{c}": F.count_if(F.col(c).isNull()) for c in REQUIRED[table]}
    if table == VIDEOS:
        checks["valid_fetch_status"] = F.count_if(~F.col("fetch_status").isin(*FETCH_STATUSES))
    values = rows.agg(*[c.alias(n) for n, c in checks.items()]).unpivot(
        [], list(checks), "constraint", "violations"
    )
    repeated = repeated_keys(table, rows).agg(F.count("*").alias("violations")).select(
        F.lit("unique_key").alias("constraint"), "violations"
    )
    return values.unionByName(repeated)


def repeated_keys(table: str, rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS[table]).count().where("count > 1")


def partition_fingerprints(table: str, rows: DataFrame) -> DataFrame:
    """Per partition of a table the number of its keys and two order-free marks of them.

    The marks are a sum and an exclusive or over a hash of each key: the same rows in any
    order and any files give the same, a repeated, missing or other key does not.
    """
    digest = F.md5(F.concat_ws("\x01", *[F.col(k) for k in KEYS[table]]).cast("binary"))
    mark = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
    return (
        rows.select(PART, mark.alias("mark"))
        .groupBy(PART)
        .agg(
            F.count("*").alias("n"),
            F.bit_xor("mark").alias("folded"),
            F.sum(F.col("mark").cast("decimal(38,0)")).cast("string").alias("total"),
        )
    )


def changed_partitions(before: DataFrame, now: DataFrame) -> DataFrame:
    """Partitions whose fingerprints differ, with the numbers of keys on both sides."""
    marks = ("n", "folded", "total")
    both = before.select(PART, F.struct(*marks).alias("was")).join(
        now.select(PART, F.struct(*marks).alias("is")), PART, "full_outer"
    )
    return both.where(~F.col("was").eqNullSafe(F.col("is"))).select(
        PART, F.coalesce("was.n", F.lit(0)).alias("keys_before"), F.coalesce("is.n", F.lit(0)).alias("keys_now")
    )


def checked_columns(table: str) -> list[Column]:
    """A table's columns, where reading a value the table does not allow is an error."""
    columns = []
    for field in SCHEMAS[table]:
        value = F.col(field.name).cast(field.dataType)
        if field.name == "fetch_status":
            bad = F.raise_error(F.concat(F.lit("fetch_status not allowed: "), value))
            value = F.when(value.isin(*FETCH_STATUSES) | value.isNull(), value).otherwise(bad)
        if field.name in REQUIRED[table]:
            missing = F.raise_error(F.lit(f"{table}.{field.name} is null"))
            value = F.coalesce(value, missing.cast(field.dataType))
        columns.append(value.alias(field.name))
    return columns


def missing_tables(present: list[str]) -> list[str]:
    """Expected tables that are not there."""
    return sorted(set(SCHEMAS) - set(present))
