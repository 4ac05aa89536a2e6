"""First load of a playlist and the batch application it shares with refresh."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.functions.outcomes import playlist_id
from captide.operators import diff, merge, summaries
from captide.schema import BRONZE, MEMBERSHIP, VIDEOS
from captide.sources import landing
from captide.sources.staging import stage, stage_counted
from captide.sources.store import Store


@dataclass(frozen=True)
class Landed:
    """What a fetcher left behind for one run.

    ``captions`` are names, ``video_id, source_language, name, file``; ``texts`` adds
    ``raw_vtt`` to rows with a ``file``.  ``snapshot`` and ``infos`` have a ``reason``
    where a line or file could not be read.
    """

    snapshot: DataFrame
    fetches: DataFrame
    captions: DataFrame
    infos: DataFrame
    texts: Callable[[DataFrame], DataFrame] = landing.read_texts

    def readable(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col("reason").isNull()).drop("value", "reason")


def read_landing(spark: SparkSession, path: str) -> Landed:
    """Scan a landing directory; an unfinished snapshot listing stops the run here."""
    landing.require_complete(spark, f"{path}/snapshot_status")
    return Landed(
        snapshot=landing.read_snapshot(spark, f"{path}/snapshot"),
        fetches=landing.read_fetch_results(spark, f"{path}/fetch_results"),
        captions=landing.list_captions(spark, f"{path}/files"),
        infos=landing.read_infos(spark, f"{path}/files"),
    )


def packed_texts(texts: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """``Landed.texts`` for captions that landed in a table of ``file, raw_vtt``."""
    return partial(landing.joined_texts, texts=texts)


def resolve_playlist_id(spark: SparkSession, url: str) -> str:
    return spark.range(1).select(playlist_id(F.lit(url))).first()[0]


def staged_labels(
    snapshot: DataFrame, members: DataFrame, videos: DataFrame
) -> tuple[DataFrame, dict[str, int]]:
    """Labels of a playlist's ids and their counts, in one pass."""
    labels = diff.label_snapshot(snapshot, members, videos)
    return stage_counted(labels, "labels", summaries.label_counts())


def labelled(
    store: Store, playlist: str, landed: Landed
) -> tuple[DataFrame, DataFrame, DataFrame, dict[str, int]]:
    """The playlist's members, the videos among them and the snapshot's, and the staged labels."""
    members = store.read_members(MEMBERSHIP, playlist)
    snapshot = stage(landed.readable(landed.snapshot).distinct(), "snapshot")
    videos = store.read_for(VIDEOS, snapshot.union(members.select("video_id")))
    labels, counts = staged_labels(snapshot, members, videos)
    return members, videos, labels, counts


def staged_outcomes(
    landed: Landed, scheduled: DataFrame, infos: DataFrame
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """The chosen caption files, the outcomes of the scheduled ids, and their counts."""
    names = diff.chosen_captions(scheduled, landed.captions, landing.empty_captions(landed.fetches))
    chosen = stage(names, "chosen")
    outcomes = diff.assemble_outcomes(scheduled, landed.fetches, chosen, infos)
    outcomes, counts = stage_counted(outcomes, "outcomes", summaries.outcome_counts())
    return chosen, outcomes, counts


def wanted_captions(bronze: DataFrame, chosen: DataFrame) -> DataFrame:
    """Chosen files of ids that Bronze does not hold.

    Bronze is first reduced to this run's ids, which reads its ids in place.
    """
    held = diff.rows_in(bronze.select("video_id"), chosen)
    return diff.rows_not_in(chosen, held)


def bronze_rows(
    wanted: DataFrame, texts: Callable[[DataFrame], DataFrame], run_ts: datetime | str
) -> DataFrame:
    """Bronze rows of wanted files; only their texts are read."""
    loaded = texts(wanted.select("video_id", "source_language", "file")).drop("file")
    return loaded.withColumn("fetched_at", merge.timestamp(run_ts))


def changed_videos(videos: DataFrame, outcomes: DataFrame, run_ts: datetime | str) -> DataFrame:
    """New versions of the videos that have a recorded outcome."""
    recorded = diff.writable(outcomes)
    return merge.upsert_videos(diff.rows_in(videos, recorded), recorded, run_ts)


def seen_ids(labels: DataFrame, outcomes: DataFrame, *touched: str) -> DataFrame:
    """Ids to record as members now: those only touched and those with a recorded fetch."""
    return diff.with_label(labels, *touched).union(diff.writable(outcomes).select("video_id"))


def changed_members(
    members: DataFrame,
    playlist: str,
    seen: DataFrame,
    run_ts: datetime | str,
    gone: DataFrame | None = None,
) -> DataFrame:
    """New versions of a playlist's members that were seen or are gone."""
    changes = merge.as_members(seen, playlist).withColumn("gone", F.lit(False))
    if gone is not None:
        removed = merge.as_members(gone, playlist).withColumn("gone", F.lit(True))
        changes = changes.union(removed)
    touched = diff.rows_in(members, changes)
    return merge.merge_membership(touched, changes, run_ts)


def staged_bronze(store: Store, landed: Landed, chosen: DataFrame, run_ts: datetime | str) -> DataFrame:
    wanted = stage(wanted_captions(store.read_for(BRONZE, chosen), chosen), "wanted")
    return store.staged(BRONZE, bronze_rows(wanted, landed.texts, run_ts))


def log_rejected(store: Store, landed: Landed, run_ts: datetime | str) -> None:
    """Append lines, files and names that could not be read, with the reason."""
    lines = landing.rejected("snapshot", landed.snapshot).where(F.col("reason") != landing.BLANK)
    infos = landing.rejected("infos", landed.infos)
    store.log_rejected(lines.union(infos).union(landing.rejected_names(landed.captions)), run_ts)


def run_ingest(
    store: Store, playlist_url: str, landed: Landed, run_ts: datetime | str
) -> dict:
    """Link known ids of a snapshot to its playlist and load the fetched new ones.

    Everything is computed and checked before the first table changes; videos, which
    decide what is new, change last.
    """
    store.create()
    playlist = resolve_playlist_id(store.spark, playlist_url)
    members, videos, labels, counts = labelled(store, playlist, landed)
    scheduled = diff.with_label(labels, diff.NEW)
    chosen, outcomes, fetched = staged_outcomes(landed, scheduled, landed.readable(landed.infos))
    result = summaries.ingest_counts({**counts, **fetched})
    seen = seen_ids(labels, outcomes, diff.RETRY, diff.TOUCH)
    linked = store.staged(MEMBERSHIP, changed_members(members, playlist, seen, run_ts))
    if counts["new"]:
        changed = store.staged(VIDEOS, changed_videos(videos, outcomes, run_ts))
        store.insert(BRONZE, staged_bronze(store, landed, chosen, run_ts))
    store.replace(MEMBERSHIP, linked)
    if counts["new"]:
        store.replace(VIDEOS, changed)
    store.log_failures(diff.failures(outcomes), run_ts)
    log_rejected(store, landed, run_ts)
    store.log_run("run_ingest", result, run_ts)
    return result
