"""One-row run summaries; every count is present even when it is zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captide.operators.diff import NEW, RETRY, TOMBSTONE, TOUCH, rows_in
from captide.schema import FETCH_STATUSES

# Removals above which a snapshot is taken for a truncated listing.
MAX_TOMBSTONES = 20


def _labelled(*labels: str) -> Column:
    return F.count_if(F.col("label").isin(*labels))


def status_counts() -> dict[str, Column]:
    return {s: F.count_if(F.col("fetch_status") == s) for s in FETCH_STATUSES}


def label_counts() -> dict[str, Column]:
    return {
        "snapshot": _labelled(NEW, RETRY, TOUCH),
        "new": _labelled(NEW),
        "tombstone": _labelled(TOMBSTONE),
        "retry_no_subtitles": _labelled(RETRY),
        "touch": _labelled(TOUCH),
    }


def outcome_counts() -> dict[str, Column]:
    return {**status_counts(), "newly_captioned": F.count_if("has_caption")}


def _row(rows: DataFrame, counts: dict[str, Column]) -> DataFrame:
    return rows.agg(*[c.alias(name) for name, c in counts.items()])


def outcome_tally(outcomes: DataFrame) -> DataFrame:
    return _row(outcomes, status_counts())


def diff_counts(labels: DataFrame) -> DataFrame:
    return _row(labels, label_counts())


def tombstone_check(labels: DataFrame, limit: int = MAX_TOMBSTONES) -> DataFrame:
    """Removal candidates and whether there are more than ``limit``, too many to believe.

    The default suits playlists of some hundred videos; larger ones need a larger limit.
    """
    return labels.agg(_labelled(TOMBSTONE).alias("candidates")).select(
        "candidates", (F.col("candidates") > limit).alias("tripped")
    )


def _one_row(labels: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Both tallies as one row: the two single rows are stacked and summed instead of joined."""
    stacked = diff_counts(labels).unionByName(_row(outcomes, outcome_counts()), allowMissingColumns=True)
    return stacked.agg(*[F.sum(c).alias(c) for c in stacked.columns])


def ingest_counts(counts: dict[str, int]) -> dict:
    """An ingest run's summary from its label and outcome counts."""
    existing = counts["retry_no_subtitles"] + counts["touch"]
    return {
        "total": counts["snapshot"],
        "new": counts["new"],
        "existing": existing,
        "linked": existing,
        **{s: counts[s] for s in FETCH_STATUSES},
        "status": "complete" if counts["new"] else "nothing_to_fetch",
    }


def refresh_counts(counts: dict[str, int]) -> dict:
    """A refresh run's summary; ``added`` counts ids scheduled as new, whatever came of them."""
    return {
        "added": counts["new"],
        "tombstoned": counts["tombstone"],
        "newly_captioned": counts["newly_captioned"],
        "status": "complete",
    }


def ingest_summary(labels: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Ids listed, new and known, the outcome counts of the fetched ones, and a status, as one row."""
    existing = F.col("retry_no_subtitles") + F.col("touch")
    return _one_row(labels, outcomes).select(
        F.col("snapshot").alias("total"),
        "new",
        existing.alias("existing"),
        existing.alias("linked"),
        *FETCH_STATUSES,
        F.when(F.col("new") == 0, "nothing_to_fetch").otherwise("complete").alias("status"),
    )


def refresh_summary(labels: DataFrame, outcomes: DataFrame) -> DataFrame:
    return _one_row(labels, outcomes).select(
        F.col("new").alias("added"),
        F.col("tombstone").alias("tombstoned"),
        "newly_captioned",
        F.lit("complete").alias("status"),
    )


def metadata_flags(ids: DataFrame, videos: DataFrame, infos: DataFrame) -> DataFrame:
    """Listed ids with how often, whether they have a video row, and whether metadata was found."""
    listed = ids.groupBy("video_id").agg(F.count("*").alias("times"))
    known = rows_in(videos.select("video_id"), ids).withColumn("known", F.lit(True))
    found = infos.where("has_info").select("video_id").distinct().withColumn("found", F.lit(True))
    return (
        listed.join(known, "video_id", "left")
        .join(found, "video_id", "left")
        .select("video_id", "times", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("known", "found")])
    )


def metadata_counts() -> dict[str, Column]:
    """Of flagged ids: updated, skipped for want of a video row, failed for want of metadata."""

    def times(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("times"))), F.lit(0))

    known, found = F.col("known"), F.col("found")
    return {"updated": times(known & found), "skipped": times(~known), "failed": times(known & ~found)}


def metadata_summary(ids: DataFrame, videos: DataFrame, infos: DataFrame) -> DataFrame:
    return _row(metadata_flags(ids, videos, infos), metadata_counts())


def transform_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("processed")).withColumn(
        "status", F.when(F.col("processed") == 0, "nothing_to_process").otherwise("complete")
    )
