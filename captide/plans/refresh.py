"""Synchronise a playlist: new ids, removals, caption retries, metadata."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.operators import diff, merge, summaries
from captide.plans.ingest import (
    Landed,
    changed_members,
    changed_videos,
    labelled,
    log_rejected,
    resolve_playlist_id,
    seen_ids,
    staged_bronze,
    staged_outcomes,
)
from captide.plans.transform import silver_rows
from captide.schema import BRONZE, MEMBERSHIP, SILVER, VIDEOS
from captide.sources.staging import stage, stage_counted
from captide.sources.store import Store


class TooManyRemovals(RuntimeError):
    """A snapshot drops so many members that it is taken for a truncated listing."""


def metadata_source(labels: DataFrame, infos: DataFrame) -> DataFrame:
    """Landed metadata of ids that are only touched this run."""
    filled = infos.where("has_info")
    return diff.rows_of(filled, diff.with_label(labels, diff.TOUCH)).withColumn("seq", F.lit(0))


def run_refresh(
    store: Store,
    playlist_url: str,
    landed: Landed,
    run_ts: datetime | str,
    refresh_metadata: bool = False,
    force_tombstone: bool = False,
    max_tombstones: int = summaries.MAX_TOMBSTONES,
) -> dict:
    """Apply a snapshot; all differences are taken from one version before any write.

    More than ``max_tombstones`` removals stop the run before it writes a table.  Videos,
    which decide what is new, change last, so a run cut off midway is completed by another.
    """
    store.create()
    playlist = resolve_playlist_id(store.spark, playlist_url)
    members, videos, labels, counts = labelled(store, playlist, landed)
    if counts["tombstone"] > max_tombstones and not force_tombstone:
        raise TooManyRemovals(
            f"{counts['tombstone']} removals exceed {max_tombstones}; "
            "pass force_tombstone to apply them"
        )
    scheduled = diff.with_label(labels, diff.NEW, diff.RETRY)
    described = (diff.NEW, diff.RETRY, diff.TOUCH) if refresh_metadata else (diff.NEW, diff.RETRY)
    readable = landed.readable(landed.infos)
    infos = stage(diff.rows_of(readable, diff.with_label(labels, *described)), "infos")
    chosen, outcomes, fetched = staged_outcomes(landed, scheduled, infos)
    result = summaries.refresh_counts({**counts, **fetched})

    changed = changed_videos(videos, outcomes, run_ts)
    if refresh_metadata:
        # Touched ids were not fetched, so these rows and the fetched ones are disjoint.
        touched = diff.with_label(labels, diff.TOUCH)
        source = metadata_source(labels, infos)
        changed = changed.unionByName(merge.update_metadata(diff.rows_in(videos, source), source))
        flags = summaries.metadata_flags(touched, videos, infos)
        result |= stage_counted(flags, "flags", summaries.metadata_counts())[1]
    synchronised = changed_members(
        members,
        playlist,
        seen_ids(labels, outcomes, diff.TOUCH),
        run_ts,
        gone=diff.with_label(labels, diff.TOMBSTONE),
    )
    changed, synchronised = store.staged(VIDEOS, changed), store.staged(MEMBERSHIP, synchronised)
    if result["newly_captioned"]:
        store.insert(BRONZE, staged_bronze(store, landed, chosen, run_ts))
        captioned = outcomes.where("has_caption").select("video_id")
        rows = diff.rows_in(store.read_for(BRONZE, captioned), captioned)
        store.replace(SILVER, store.staged(SILVER, silver_rows(rows, run_ts)))
    store.replace(MEMBERSHIP, synchronised)
    store.replace(VIDEOS, changed)
    store.log_failures(diff.failures(outcomes), run_ts)
    log_rejected(store, landed, run_ts)
    store.log_run("run_refresh", result, run_ts)
    return result
