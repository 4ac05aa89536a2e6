"""Views for readers: exported documents, a browsable list, one transcript."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gold_documents(silver: DataFrame, videos: DataFrame) -> DataFrame:
    """One markdown document per transcript, with whatever metadata is known."""
    fields = {
        "Channel": F.col("channel_name"),
        "Uploaded": F.col("upload_date").cast("string"),
        "Duration (s)": F.col("duration").cast("string"),
        "Views": F.col("view_count").cast("string"),
        "Language": F.col("source_language"),
    }
    # concat is null with a null part and concat_ws leaves nulls out: unknown fields vanish.
    lines = [F.concat(F.lit(f"- {label}: "), value) for label, value in fields.items()]
    metadata = videos.select(
        "video_id", "title", "channel_name", "upload_date", "duration", "view_count"
    )
    return silver.join(metadata, "video_id", "left").select(
        "video_id",
        F.concat_ws(
            "\n\n",
            F.concat(F.lit("# "), F.coalesce("title", "video_id")),
            F.concat_ws("\n", *lines),
            F.col("full_text"),
        ).alias("document"),
    )


# Rows sorted at most to find a page, besides its own.
SKIPPED_ROWS = 10_000

def newest_first() -> list[Column]:
    return [F.col("upload_date").desc_nulls_last(), F.col("video_id").asc()]


def listed(
    videos: DataFrame,
    channel: str | None = None,
    uploaded_from: str | None = None,
    uploaded_to: str | None = None,
) -> DataFrame:
    """Videos of a channel and a range of upload dates."""
    if channel is not None:
        videos = videos.where(F.col("channel_name") == channel)
    if uploaded_from is not None:
        videos = videos.where(F.col("upload_date") >= F.lit(uploaded_from).cast("date"))
    if uploaded_to is not None:
        videos = videos.where(F.col("upload_date") <= F.lit(uploaded_to).cast("date"))
    return videos


def _skipped(groups: DataFrame, key: str, order: Column, offset: int) -> tuple[object, int] | None:
    """The group that holds the row at an offset, and how many of its rows come before that row."""
    for row in groups.groupBy(key).agg(F.count("*").alias("n")).orderBy(order).toLocalIterator():
        if offset < row.n:
            return row[key], offset
        offset -= row.n
    return None


def rows_from(videos: DataFrame, offset: int, most: int = SKIPPED_ROWS) -> tuple[DataFrame, int]:
    """The list from near an offset on, and the rows still to skip, ``most`` at most.

    Videos are counted per upload date, then within the date that holds the offset per
    first letters of their id, one letter more at a time; each count reads the rows of
    one group only.  The driver sees a count per date, and one per next letter.
    """
    found = _skipped(videos, "upload_date", F.col("upload_date").desc_nulls_last(), offset)
    if found is None:
        return videos.limit(0), 0
    day, left = found
    same_day = F.col("upload_date").eqNullSafe(F.lit(day).cast("date"))
    later = F.col("upload_date").isNull() if day is not None else F.lit(False)
    if day is not None:
        later = later | (F.col("upload_date") < F.lit(day).cast("date"))
    of_day, prefix, letters = videos.where(same_day), "", 0
    while left > most:
        letters += 1
        groups = of_day.where(F.startswith("video_id", F.lit(prefix))).withColumn("start", F.substring("video_id", 1, letters))
        prefix, left = _skipped(groups, "start", F.col("start"), left)
    return videos.where(later | (same_day & (F.col("video_id") >= prefix))), left


def browse(
    videos: DataFrame,
    channel: str | None = None,
    uploaded_from: str | None = None,
    uploaded_to: str | None = None,
    page: int = 1,
    page_size: int = 50,
    most: int = SKIPPED_ROWS,
) -> DataFrame:
    """One page of the video list, newest first.

    A far page does not sort all rows before it: rows are skipped by counts, and at most
    ``most`` of them are sorted besides the page's own.
    """
    rows, offset = listed(videos, channel, uploaded_from, uploaded_to), (page - 1) * page_size
    if offset > most:
        rows, offset = rows_from(rows, offset, most)
    return rows.orderBy(*newest_first()).offset(offset).limit(page_size)


def browse_after(videos: DataFrame, upload_date: str | None, video_id: str, page_size: int = 50) -> DataFrame:
    """The page after a row, named by its date and id; nothing before it is read or counted."""
    day = F.lit(upload_date).cast("date")
    later = (F.col("upload_date").eqNullSafe(day)) & (F.col("video_id") > video_id)
    if upload_date is not None:
        later = later | (F.col("upload_date") < day) | F.col("upload_date").isNull()
    return videos.where(later).orderBy(*newest_first()).limit(page_size)


def transcript(silver: DataFrame, video_id: str) -> DataFrame:
    return silver.where(F.col("video_id") == video_id)
