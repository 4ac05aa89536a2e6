"""Table shapes, keys and allowed values."""

from __future__ import annotations

from pyspark.sql import types as T

VIDEOS = "videos"
MEMBERSHIP = "playlist_video_membership"
BRONZE = "transcripts_bronze"
SILVER = "transcripts_silver"

# Fixed values.
FETCH_STATUSES = ("ok", "no_subtitles", "unavailable", "rate_limited")

# The suffix of caption files and the language assumed when a name has none.
CAPTION_SUFFIX = ".vtt"
DEFAULT_LANGUAGE = "en"
# The characters of an id.
ID = "[A-Za-z0-9_-]+"

METADATA_COLUMNS = (
    "title",
    "channel_name",
    "channel_id",
    "upload_date",
    "duration",
    "view_count",
)


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


SCHEMAS: dict[str, T.StructType] = {
    VIDEOS: _table(
        ("video_id", T.StringType()),
        ("title", T.StringType()),
        ("channel_name", T.StringType()),
        ("channel_id", T.StringType()),
        ("upload_date", T.DateType()),
        ("duration", T.IntegerType()),
        ("view_count", T.LongType()),
        ("fetch_status", T.StringType()),
        ("ingested_at", T.TimestampType()),
    ),
    MEMBERSHIP: _table(
        ("playlist_id", T.StringType()),
        ("video_id", T.StringType()),
        ("first_seen_at", T.TimestampType()),
        ("last_seen_at", T.TimestampType()),
        ("removed_at", T.TimestampType()),
    ),
    BRONZE: _table(
        ("video_id", T.StringType()),
        ("raw_vtt", T.StringType()),
        ("source_language", T.StringType()),
        ("fetched_at", T.TimestampType()),
    ),
    SILVER: _table(
        ("video_id", T.StringType()),
        ("full_text", T.StringType()),
        ("source_language", T.StringType()),
        ("transformed_at", T.TimestampType()),
    ),
}

KEYS: dict[str, tuple[str, ...]] = {
    VIDEOS: ("video_id",),
    MEMBERSHIP: ("playlist_id", "video_id"),
    BRONZE: ("video_id",),
    SILVER: ("video_id",),
}

REQUIRED: dict[str, tuple[str, ...]] = {
    VIDEOS: ("video_id", "fetch_status", "ingested_at"),
    MEMBERSHIP: ("playlist_id", "video_id", "first_seen_at", "last_seen_at"),
    BRONZE: ("video_id", "raw_vtt", "source_language", "fetched_at"),
    SILVER: ("video_id", "full_text", "source_language", "transformed_at"),
}

# Stored tables are partitioned by a hash of this column.
PART = "part"
PART_KEYS = {VIDEOS: "video_id", MEMBERSHIP: "playlist_id", BRONZE: "video_id", SILVER: "video_id"}

# One row per run; counts that a job does not have are null.
RUN_COUNTS = (
    "total",
    "existing",
    "new",
    "linked",
    *FETCH_STATUSES,
    "added",
    "tombstoned",
    "newly_captioned",
    "updated",
    "skipped",
    "failed",
    "processed",
    "written",
    "bronze_count",
    "silver_count",
    "ok_videos_count",
    "empty_silver",
)
RUN_LOG = _table(
    ("action", T.StringType()),
    ("run_ts", T.TimestampType()),
    ("status", T.StringType()),
    *[(name, T.LongType()) for name in RUN_COUNTS],
)
