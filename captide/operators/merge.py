"""Keyed merges as DataFrame functions: ``(target, source, run_ts) -> new target``.

A source may hold several rows per key, in ``seq`` order.  Each merge first
reduces it to one row per key with an aggregate that combines on the map side,
so one key holding a large share of the source never meets in one task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captide.schema import METADATA_COLUMNS

KEY = "video_id"
MEMBER_KEY = ["playlist_id", KEY]


def timestamp(run_ts: datetime | str) -> Column:
    return F.lit(run_ts).cast("timestamp")


def _last_outcomes(source: DataFrame) -> DataFrame:
    """Per video: the last status, and the metadata of the last row that has any."""
    info = F.when(F.col("has_info"), F.struct(*METADATA_COLUMNS))
    info_seq = F.when(F.col("has_info"), F.col("seq"))
    return source.groupBy(KEY).agg(
        F.max_by("fetch_status", "seq").alias("new_status"),
        F.max_by(info, info_seq).alias("info"),
    )


def upsert_videos(videos: DataFrame, source: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Insert or update videos.

    With metadata all six columns are overwritten, nulls included; without it only
    the status changes.  ``ingested_at`` is set once.
    """
    has_info = F.col("info").isNotNull()
    return videos.join(_last_outcomes(source), KEY, "full_outer").select(
        KEY,
        *[
            F.when(has_info, F.col(f"info.{c}")).otherwise(videos[c]).alias(c)
            for c in METADATA_COLUMNS
        ],
        F.coalesce("new_status", videos["fetch_status"]).alias("fetch_status"),
        F.coalesce(videos["ingested_at"], timestamp(run_ts)).alias("ingested_at"),
    )


def update_metadata(videos: DataFrame, source: DataFrame) -> DataFrame:
    """Overwrite metadata of existing videos; statuses stay and nothing is inserted."""
    info = F.struct(*METADATA_COLUMNS)
    last = source.where("has_info").groupBy(KEY).agg(F.max_by(info, "seq").alias("info"))
    has_info = F.col("info").isNotNull()
    return videos.join(last, KEY, "left").select(
        KEY,
        *[
            F.when(has_info, F.col(f"info.{c}")).otherwise(videos[c]).alias(c)
            for c in METADATA_COLUMNS
        ],
        videos["fetch_status"],
        videos["ingested_at"],
    )


def rows_to_insert(target: DataFrame, source: DataFrame) -> DataFrame:
    """First source row of each key the target does not hold.

    The outer join stays above the grouping; an anti join would be moved below it
    and shuffle every repeat of a key.
    """
    columns = [c for c in source.columns if c not in (KEY, "seq")]
    first = source.groupBy(KEY).agg(F.min_by(F.struct(*columns), "seq").alias("row"))
    held = target.select(KEY, F.lit(True).alias("held"))
    return (
        first.join(held, KEY, "left")
        .where(F.col("held").isNull())
        .select(KEY, *[F.col(f"row.{c}").alias(c) for c in columns])
    )


def insert_only(target: DataFrame, source: DataFrame) -> DataFrame:
    """Append rows with new keys; an existing row is never changed."""
    return target.unionByName(rows_to_insert(target, source).select(*target.columns))


def merge_membership(
    membership: DataFrame, changes: DataFrame, run_ts: datetime | str
) -> DataFrame:
    """Apply ``playlist_id, video_id, gone`` changes.

    Seen members are inserted or become active again; members that are gone get a
    tombstone if they are active.  Both go through one join on the full key, which
    is unique, so neither a large playlist nor a popular video makes a hot task.
    """
    change = changes.groupBy(*MEMBER_KEY).agg(F.bool_and("gone").alias("gone"))
    now = timestamp(run_ts)
    seen, gone = ~F.col("gone"), F.col("gone")
    return (
        membership.join(change, MEMBER_KEY, "full_outer")
        .where(F.col("first_seen_at").isNotNull() | seen)
        .select(
            *MEMBER_KEY,
            F.coalesce("first_seen_at", now).alias("first_seen_at"),
            F.when(seen, now).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
            F.when(seen, None)
            .when(gone & F.col("removed_at").isNull(), now)
            .otherwise(F.col("removed_at"))
            .alias("removed_at"),
        )
    )


def upsert_membership(
    membership: DataFrame, source: DataFrame, run_ts: datetime | str
) -> DataFrame:
    """Record members as seen now; a tombstoned member becomes active again."""
    changes = source.select(*MEMBER_KEY, F.lit(False).alias("gone"))
    return merge_membership(membership, changes, run_ts)


def as_members(ids: DataFrame, playlist_id: str) -> DataFrame:
    return ids.select(F.lit(playlist_id).alias("playlist_id"), KEY)


def touch_membership(
    membership: DataFrame, playlist_id: str, ids: DataFrame, run_ts: datetime | str
) -> DataFrame:
    return upsert_membership(membership, as_members(ids, playlist_id), run_ts)


def tombstone(
    membership: DataFrame, playlist_id: str, ids: DataFrame, run_ts: datetime | str
) -> DataFrame:
    """Mark listed active members of one playlist as removed."""
    changes = as_members(ids, playlist_id).withColumn("gone", F.lit(True))
    return merge_membership(membership, changes, run_ts)


def count_removed(membership: DataFrame, playlist_id: str, ids: DataFrame) -> DataFrame:
    """How many of the listed ids carry a tombstone in a playlist."""
    removed = membership.where(
        (F.col("playlist_id") == playlist_id) & F.col("removed_at").isNotNull()
    )
    return removed.join(ids.select(KEY).distinct(), KEY, "left_semi").agg(F.count("*").alias("tombstoned"))


def replace_rows(target: DataFrame, rows: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Rows take the place of those with the same key; the rest stay."""
    key = key or [KEY]
    kept = target.join(rows.select(*key), key, "left_anti")
    return kept.unionByName(rows.select(*target.columns))
