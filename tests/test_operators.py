"""Merges, diffs and audits on small tables, and their behaviour under skew."""

import random
import re

import pytest
from pyspark.sql import functions as F

from captide.operators import diff, merge, quality, reading, summaries
from captide.schema import KEYS, SCHEMAS, VIDEOS

T0, T1 = "2026-01-01 00:00:00", "2026-01-02 00:00:00"
OUTCOME = (
    "video_id string, fetch_status string, has_info boolean, title string, channel_name string, "
    "channel_id string, upload_date date, duration int, view_count long, seq long"
)


def outcome(video, status, seq, title=None, has_info=None):
    filled = title is not None if has_info is None else has_info
    return (video, status, filled, title, None, None, None, None, None, seq)


def video_rows(spark, rows):
    empty = spark.createDataFrame([], SCHEMAS[VIDEOS])
    source = spark.createDataFrame(rows, OUTCOME)
    return merge.upsert_videos(empty, source, T0)


def picked(rows, *columns):
    return sorted(tuple(str(v) for v in r) for r in rows.select(*columns).collect())


def test_video_upsert(spark):
    stored = video_rows(spark, [outcome("a", "ok", 1, "A"), outcome("b", "ok", 1, "B")])
    source = spark.createDataFrame(
        [
            outcome("a", "unavailable", 1),
            outcome("b", "ok", 1, None, has_info=True),
            outcome("c", "ok", 1, "C1"),
            outcome("c", "no_subtitles", 2),
        ],
        OUTCOME,
    )
    merged = merge.upsert_videos(stored, source, T1)
    assert picked(merged, "video_id", "fetch_status", "title", "ingested_at") == [
        ("a", "unavailable", "A", T0),
        ("b", "ok", "None", T0),
        ("c", "no_subtitles", "C1", T1),
    ]


def test_metadata_update_never_inserts(spark):
    stored = video_rows(spark, [outcome("a", "no_subtitles", 1, "A"), outcome("b", "ok", 1, "B")])
    source = spark.createDataFrame(
        [outcome("a", "ok", 1, "A2"), outcome("a", "ok", 2), outcome("z", "ok", 1, "Z")], OUTCOME
    )
    assert picked(merge.update_metadata(stored, source), "video_id", "fetch_status", "title") == [
        ("a", "no_subtitles", "A2"),
        ("b", "ok", "B"),
    ]


def test_first_bronze_write_wins(spark):
    held = spark.createDataFrame([("a", "old")], "video_id string, raw_vtt string")
    source = spark.createDataFrame(
        [("a", "new", 1), ("b", "first", 1), ("b", "second", 2)],
        "video_id string, raw_vtt string, seq long",
    )
    assert picked(merge.insert_only(held, source), "video_id", "raw_vtt") == [
        ("a", "old"),
        ("b", "first"),
    ]


def test_replayed_snapshots(spark):
    """Touching and tombstoning day by day leaves first, last and absent days right."""
    pick = random.Random(2)
    snapshots = [{f"v{pick.randint(0, 30)}" for _ in range(25)} for _ in range(4)]
    members = spark.createDataFrame([], SCHEMAS["playlist_video_membership"])
    seen = {}
    for day, ids in enumerate(snapshots, 1):
        now = f"2026-01-0{day} 00:00:00"
        frame = spark.createDataFrame([(i,) for i in sorted(ids)], "video_id string")
        gone = diff.rows_not_in(diff.active_members(members, "P"), frame)
        members = merge.tombstone(members, "P", gone, now)
        members = merge.touch_membership(members, "P", frame, now)
        members = spark.createDataFrame(members.collect(), members.schema)
        for i in set(seen) | ids:
            first, last, removed = seen.get(i, (now, now, None))
            seen[i] = (first, now, None) if i in ids else (first, last, removed or now)
    got = {r.video_id: r for r in members.collect()}
    assert set(got) == set(seen)
    for i, (first, last, removed) in seen.items():
        row = got[i]
        assert (str(row.first_seen_at), str(row.last_seen_at)) == (first, last)
        assert (row.removed_at and str(row.removed_at)) == removed


def test_tombstone_spares_others(spark):
    rows = [("P", "a"), ("P", "b"), ("Q", "a")]
    source = spark.createDataFrame(rows, "playlist_id string, video_id string")
    empty = spark.createDataFrame([], SCHEMAS["playlist_video_membership"])
    members = merge.upsert_membership(empty, source, T0)
    ids = spark.createDataFrame([("a",), ("zz",)], "video_id string")
    after = merge.tombstone(members, "P", ids, T1)
    assert picked(after, "playlist_id", "video_id", "removed_at") == [
        ("P", "a", T1), ("P", "b", "None"), ("Q", "a", "None"),
    ]
    again = merge.tombstone(after, "P", ids, "2026-01-09 00:00:00")
    assert picked(again, "removed_at") == picked(after, "removed_at")
    assert merge.count_removed(after, "P", ids).first()[0] == 1


def test_zero_filled_tallies(spark):
    none = spark.createDataFrame([], "video_id string, fetch_status string, has_caption boolean")
    labels = spark.createDataFrame([], "video_id string, label string")
    assert tuple(summaries.outcome_tally(none).first()) == (0, 0, 0, 0)
    assert tuple(summaries.diff_counts(labels).first()) == (0, 0, 0, 0, 0)
    assert summaries.ingest_summary(labels, none).first().status == "nothing_to_fetch"
    assert tuple(summaries.refresh_summary(labels, none).first()) == (0, 0, 0, "complete")


@pytest.mark.parametrize(("removed", "tripped"), [(20, False), (21, True)])
def test_tombstone_limit(spark, removed, tripped):
    labels = spark.range(removed).select(F.lit("tombstone").alias("label"))
    assert summaries.tombstone_check(labels).first().tripped is tripped


def test_constraints(spark):
    rows = spark.createDataFrame(
        [("a", "ok", T0), ("a", "ok", T0), (None, "odd", None)],
        "video_id string, fetch_status string, ingested_at string",
    )
    got = dict(tuple(r) for r in quality.constraint_audit(VIDEOS, rows).collect())
    assert got == {
        "not_null_video_id": 1, "not_null_fetch_status": 0, "not_null_ingested_at": 1,
        "valid_fetch_status": 1, "unique_key": 1,
    }


def test_missing_tables():
    assert quality.missing_tables({t: [] for t in SCHEMAS}) == []
    assert quality.missing_tables({}) == sorted(SCHEMAS) == sorted(KEYS)


def test_gold_document_leaves_out_unknown_fields(spark):
    silver = spark.createDataFrame(
        [("a", "text", "en"), ("b", "more", "en")],
        "video_id string, full_text string, source_language string",
    )
    docs = {r[0]: r[1] for r in reading.gold_documents(silver, video_rows(spark, [outcome("a", "ok", 1, "A")])).collect()}
    assert docs == {"a": "# A\n\n- Language: en\n\ntext", "b": "# b\n\n- Language: en\n\nmore"}


def test_browse_pages(spark):
    rows = video_rows(spark, [outcome(f"v{i}", "ok", 1, "T") for i in range(5)])
    assert [r.video_id for r in reading.browse(rows, page=2, page_size=2).collect()] == ["v2", "v3"]
    assert reading.browse(rows, channel="none").count() == 0


def shuffled_before_grouping(frame):
    """Whether some shuffle moves rows that a grouping above it could have merged."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    lines = [re.sub(r"^[\s:+\-]*(\(\d+\) )?", "", line) for line in plan.splitlines()]
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines()]
    raw = []
    for at, line in enumerate(lines):
        if line.startswith("Exchange hashpartitioning"):
            below = []
            for d, inner in zip(depth[at + 1 :], lines[at + 1 :], strict=True):
                if d <= depth[at]:
                    break
                below.append(inner)
            if not any("Aggregate" in b for b in below):
                raw.append(line)
    return raw


def test_repeated_ids_are_merged_before_they_are_shuffled(spark):
    """One id may fill a third of a source; only stored tables, unique by key, move unmerged."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = spark.range(300).select(
            F.when(F.col("id") < 100, "hot").otherwise(F.col("id").cast("string")).alias("video_id"),
            F.col("id").alias("seq"),
            F.lit("x").alias("raw_vtt"),
        )
        stored = spark.range(50).select(
            F.col("id").cast("string").alias("video_id"), F.lit("y").alias("raw_vtt")
        )
        for frame in (
            merge.rows_to_insert(stored, hot),
            diff.with_known(hot, stored),
            diff.rows_in(stored, hot),
            diff.rows_not_in(stored, hot),
        ):
            # The stored side is shuffled as it is; the hot side never is.
            assert len(shuffled_before_grouping(frame)) <= 1, frame.explain()
            frame.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_id_lists_filter_large_tables_before_they_are_shuffled(spark):
    from captide.sources import landing
    from captide.sources.staging import stage

    labels = stage(spark.range(50).selectExpr("cast(id as string) video_id", "if(id < 9, 'new', 'touch') label"), "labels")
    texts = stage(spark.range(500).selectExpr("cast(id as string) video_id", "cast(id as string) file", "'x' raw_vtt"), "texts")
    chosen = stage(labels.where("label = 'new'").selectExpr("video_id", "'en' source_language", "video_id file"), "chosen")
    bloom = "spark.sql.optimizer.runtime.bloomFilter"
    settings = {
        f"{bloom}.applicationSideScanSizeThreshold": "1", f"{bloom}.creationSideThreshold": "1MB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        of_new = diff.rows_of(texts, diff.with_label(labels, diff.NEW))
        loaded = landing.joined_texts(chosen, texts.select("file", "raw_vtt"))
        for rows, found in ((of_new, 9), (loaded, 9)):
            plan = rows._jdf.queryExecution().optimizedPlan().toString()
            assert "might_contain" in plan and rows.count() == found
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
