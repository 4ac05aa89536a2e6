"""Load the membership of many past snapshots in one run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.operators.backfill import numbered_snapshots, resumed_membership
from captide.schema import MEMBERSHIP, SCHEMAS
from captide.sources.staging import stage
from captide.sources.store import Store


def run_backfill(store: Store, listed: DataFrame, snapshots: DataFrame | None, run_ts: datetime | str) -> dict:
    """Bring the members of some playlists up to date from ``playlist_id, video_id, at`` rows.

    The snapshots must be later than what is stored of their playlists.  ``snapshots``,
    ``playlist_id, at``, names those that list nothing too.  Only the partitions of these
    playlists are read and written.
    """
    store.create()
    listed = stage(listed.select("playlist_id", "video_id", "at").distinct(), "listed")
    taken = numbered_snapshots(listed, snapshots)
    playlists = stage(taken.groupBy("playlist_id").agg(F.count("*").alias("snapshots")), "playlists")
    members = store.read_for(MEMBERSHIP, playlists).join(playlists.select("playlist_id"), "playlist_id", "left_semi")
    changed = resumed_membership(members.select(*SCHEMAS[MEMBERSHIP].names), listed, snapshots)
    store.replace(MEMBERSHIP, store.staged(MEMBERSHIP, changed))
    counts = playlists.agg(F.count("*").alias("playlists"), F.coalesce(F.sum("snapshots"), F.lit(0)).alias("snapshots"))
    result = {**counts.first().asDict(), "status": "complete"}
    store.log_run("run_backfill", result, run_ts)
    return result
