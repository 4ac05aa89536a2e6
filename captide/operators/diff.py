"""Snapshot differences and the assembly of fetch outcomes.

All joins are equi-joins on ``video_id`` over id-sized rows; transcript text is
never part of a diff.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captide.functions.outcomes import error_detail, resolve_outcome
from captide.schema import CAPTION_SUFFIX, DEFAULT_LANGUAGE, ID, METADATA_COLUMNS

KEY = "video_id"

NEW = "new"
RETRY = "retry"
TOUCH = "touch"
TOMBSTONE = "tombstone"
INACTIVE = "inactive"


def members_of(membership: DataFrame, playlist_id: str) -> DataFrame:
    return membership.where(F.col("playlist_id") == playlist_id)


def active_members(membership: DataFrame, playlist_id: str) -> DataFrame:
    """Ids of a playlist without a tombstone."""
    return members_of(membership, playlist_id).where(F.col("removed_at").isNull()).select(KEY)


def rows_in(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of listed ids.  The list's repeats are merged before it is shuffled."""
    return rows.join(ids.select(KEY).distinct(), KEY, "left_semi")


def rows_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows_in`` for a list without repeats.

    With nothing between the list's filter and the join, Spark can make a Bloom filter of
    the ids at run time and apply it to a large table before that is shuffled.
    """
    return rows.join(ids.select(KEY), KEY, "left_semi")


def rows_not_in(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ids that are not listed."""
    return rows.join(ids.select(KEY).distinct(), KEY, "left_anti")


def with_known(ids: DataFrame, videos: DataFrame) -> DataFrame:
    """Distinct ids with a flag for those that have a video row.

    A semi or anti join would be moved below the grouping, where one id repeated
    in much of a list meets in a single task; an outer join stays above it.
    """
    found = rows_in(videos.select(KEY), ids).withColumn("known", F.lit(True))
    return (
        ids.select(KEY)
        .distinct()
        .join(found, KEY, "left")
        .select(KEY, F.coalesce("known", F.lit(False)).alias("known"))
    )


def awaiting_captions(videos: DataFrame, ids: DataFrame) -> DataFrame:
    """Listed videos whose last fetch found no subtitles."""
    return rows_in(videos.where(F.col("fetch_status") == "no_subtitles").select(KEY), ids)


def pending_transcripts(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Bronze rows without a Silver row; ids are unique on both sides."""
    return bronze.join(silver.select(KEY), KEY, "left_anti")


def label_snapshot(snapshot: DataFrame, members: DataFrame, videos: DataFrame) -> DataFrame:
    """Every id of a snapshot or of one playlist's members with what to do about it.

    ``members`` are the playlist's rows (``video_id, removed_at``).  The labels are
    disjoint, so no id is fetched twice in a run.
    """
    nothing = F.lit(None).cast("boolean")
    listed = snapshot.select(KEY, F.lit(True).alias("listed"), nothing.alias("active"))
    belonging = members.select(
        KEY, nothing.alias("listed"), F.col("removed_at").isNull().alias("active")
    )
    # One grouping merges repeated listings and both sides, and leaves the ids
    # partitioned for the join with the videos.
    ids = (
        listed.unionByName(belonging)
        .groupBy(KEY)
        .agg(F.bool_or("listed").alias("listed"), F.bool_or("active").alias("active"))
    )
    # Reduced to the ids at hand first: a semi join reads each stored segment in
    # place, an outer join would shuffle all videos.
    known = rows_in(videos.select(KEY, F.col("fetch_status").alias("status")), ids)
    return ids.join(known, KEY, "left").select(
        KEY,
        F.when(F.col("listed") & F.col("status").isNull(), NEW)
        .when(F.col("listed") & (F.col("status") == "no_subtitles"), RETRY)
        .when(F.col("listed"), TOUCH)
        .when(F.col("active"), TOMBSTONE)
        .otherwise(INACTIVE)
        .alias("label"),
    )


def with_label(labels: DataFrame, *wanted: str) -> DataFrame:
    return labels.where(F.col("label").isin(*wanted)).select(KEY)


def first_captions(captions: DataFrame) -> DataFrame:
    """One caption per video: the first language in order when several files landed."""
    return (
        captions.groupBy(KEY)
        .agg(F.min(F.struct("source_language", "raw_vtt")).alias("caption"))
        .select(KEY, "caption.source_language", "caption.raw_vtt")
    )


def chosen_captions(ids: DataFrame, names: DataFrame, empty: DataFrame) -> DataFrame:
    """``video_id, source_language, file`` of one caption per listed id, by its name alone.

    The first language in order is taken.  An id without a file named for it takes one
    whose name is no id's but has this id as a word among others.  An id of ``empty``
    without any has a caption without a file.  No text is part of this: the texts of the
    chosen files are read afterwards.
    """
    listed = ids.select(KEY).distinct()
    first = F.min(F.struct("source_language", "file")).alias("caption")
    own = names.groupBy(KEY).agg(first)
    words = (
        names.where(~F.col(KEY).rlike(f"^{ID}$"))
        .select(F.explode(F.array_distinct(F.regexp_extract_all("name", F.lit(ID), 0))).alias(KEY), "name", "file")
        .groupBy(KEY)
        .agg(F.min(F.struct(_language_after(F.col(KEY)).alias("source_language"), "file")).alias("other"))
    )
    named = empty.select(KEY, F.col("source_language").alias("named"))
    found = listed.join(own, KEY, "left").join(words, KEY, "left").join(named, KEY, "left")
    caption = F.coalesce("caption", F.when(F.col("named").isNull(), F.col("other")))
    return (
        found.select(KEY, caption.alias("c"), "named")
        .where(F.col("c").isNotNull() | F.col("named").isNotNull())
        .select(KEY, F.coalesce("c.source_language", "named").alias("source_language"), F.col("c.file").alias("file"))
    )


def _language_after(video_id: Column) -> Column:
    """Language of a file whose name only contains an id: what follows it at the start, else the default."""
    start = F.concat(video_id, F.lit("."))
    rest = F.substr("name", F.length(start) + 1, F.length("name") - F.length(start) - len(CAPTION_SUFFIX))
    return F.when(F.startswith("name", start) & (rest != ""), rest).otherwise(DEFAULT_LANGUAGE)


def failures(outcomes: DataFrame) -> DataFrame:
    """Failed fetches with what to report of each: id, status and a short error text."""
    return outcomes.where((F.col("returncode") != 0) & ~F.col("has_caption")).select(
        KEY, "fetch_status", error_detail(F.col("stderr")).alias("detail")
    )


def assemble_outcomes(
    ids: DataFrame, fetches: DataFrame, captions: DataFrame, infos: DataFrame
) -> DataFrame:
    """Outcome, caption presence and metadata of each listed id that was fetched.

    ``captions`` needs only its ids.  An id with neither an exit code nor a caption
    has not been fetched yet and is left out, so the next run schedules it again.
    Sources are reduced to one row per id before any join.
    """
    last_fetch = fetches.groupBy(KEY).agg(
        F.max_by(F.struct("returncode", "stderr"), "seq").alias("fetch")
    )
    captioned = captions.select(KEY).distinct().withColumn("captioned", F.lit(True))
    info = F.struct(*METADATA_COLUMNS)
    one_info = infos.where("has_info").groupBy(KEY).agg(F.max(info).alias("info"))
    has_caption = F.coalesce("captioned", F.lit(False))
    return (
        ids.select(KEY)
        .distinct()
        .join(last_fetch, KEY, "left")
        .join(captioned, KEY, "left")
        .where(F.col("fetch").isNotNull() | has_caption)
        .join(one_info, KEY, "left")
        .select(
            KEY,
            resolve_outcome(has_caption, F.col("fetch.returncode"), F.col("fetch.stderr")).alias(
                "fetch_status"
            ),
            has_caption.alias("has_caption"),
            F.col("info").isNotNull().alias("has_info"),
            *[F.col(f"info.{c}").alias(c) for c in METADATA_COLUMNS],
            F.lit(0).cast("long").alias("seq"),
            F.col("fetch.returncode").alias("returncode"),
            F.col("fetch.stderr").alias("stderr"),
        )
    )


def writable(outcomes: DataFrame) -> DataFrame:
    """Outcomes that are recorded; a rate-limited id stays as it was and is fetched again."""
    return outcomes.where(F.col("fetch_status") != "rate_limited")
