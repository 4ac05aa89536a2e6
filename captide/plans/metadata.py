"""Metadata refresh of listed videos."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.operators import diff, merge, summaries
from captide.schema import VIDEOS
from captide.sources.staging import stage, stage_counted
from captide.sources.store import Store


def run_metadata_refresh(
    store: Store, ids: DataFrame, infos: DataFrame, run_ts: datetime | str
) -> dict:
    """Overwrite metadata of listed existing videos from landed metadata files."""
    videos = store.read_for(VIDEOS, ids)
    readable = infos.where(F.col("reason").isNull()).drop("value", "reason")
    infos = stage(diff.rows_in(readable, ids), "infos")
    flags = summaries.metadata_flags(ids, videos, infos)
    result = stage_counted(flags, "flags", summaries.metadata_counts())[1]
    if result["updated"]:
        source = infos.where("has_info").withColumn("seq", F.lit(0))
        updated = merge.update_metadata(diff.rows_in(videos, source), source)
        store.replace(VIDEOS, store.staged(VIDEOS, updated))
    store.log_run("refresh_metadata", result, run_ts)
    return result
