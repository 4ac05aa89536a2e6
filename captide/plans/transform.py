"""Bronze to Silver."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.functions.text import transcript_text
from captide.operators.diff import pending_transcripts, rows_in
from captide.operators.merge import timestamp
from captide.operators.summaries import transform_summary
from captide.schema import BRONZE, SILVER
from captide.sources.store import Store


def select_transcripts(
    bronze: DataFrame, silver: DataFrame, force: bool = False, ids: DataFrame | None = None
) -> DataFrame:
    """Listed rows if ids are given, else all rows when forced, else those not in Silver."""
    if ids is not None:
        return rows_in(bronze, ids)
    if force:
        return bronze
    return pending_transcripts(bronze, silver)


def silver_rows(bronze: DataFrame, run_ts: datetime | str) -> DataFrame:
    return bronze.select(
        "video_id",
        transcript_text(F.col("raw_vtt")).alias("full_text"),
        "source_language",
        timestamp(run_ts).alias("transformed_at"),
    )


def with_difference(silver: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` and whether each ``differs`` from the Silver row of its id.

    Both sides are joined where they are stored; no text is moved.
    """
    held = silver.select("video_id", F.struct("full_text", "source_language").alias("held"))
    same = F.struct("full_text", "source_language").eqNullSafe(F.col("held"))
    return rows.join(held, "video_id", "left").select(*rows.columns, (~same).alias("differs"))


def run_transform(
    store: Store,
    run_ts: datetime | str,
    force: bool = False,
    ids: DataFrame | None = None,
) -> dict:
    """Clean selected Bronze rows into Silver; re-running does nothing new.

    An empty id list selects by mode, as if none had been given; a list reads only the
    partitions of its ids.  Every selected row is ``processed``; of a forced run only rows
    whose result differs from the stored one are ``written``, so one over unchanged
    captions writes nothing and keeps their timestamps.
    """
    if ids is not None and ids.isEmpty():
        ids = None
    bronze = store.read(BRONZE) if ids is None else store.read_for(BRONZE, ids)
    silver = store.read(SILVER)
    selected = select_transcripts(bronze, silver, force=force, ids=ids)
    rows = silver_rows(selected, run_ts)
    if force and ids is None:
        rows = with_difference(silver, rows)
    else:
        rows = rows.withColumn("differs", F.lit(True))
    counts = {"processed": F.count("*"), "written": F.count_if("differs")}
    rows, result = store.staged_counted(SILVER, rows, counts, keep="differs")
    if result["written"]:
        store.replace(SILVER, rows)
    result["status"] = "complete" if result["processed"] else "nothing_to_process"
    store.log_run("run_transform", result, run_ts)
    return result
