"""Jobs end to end on landing directories, following the behaviours users rely on."""

import json

import pytest
from pyspark.sql import functions as F

from captide.operators.quality import ConstraintViolation
from captide.plans.ingest import read_landing, run_ingest
from captide.plans.metadata import run_metadata_refresh
from captide.plans.refresh import TooManyRemovals, run_refresh
from captide.plans.transform import run_transform, select_transcripts
from captide.plans.validate import run_validate
from captide.schema import BRONZE, MEMBERSHIP, SILVER, VIDEOS
from captide.sources.landing import IncompleteSnapshot
from captide.sources.staging import stage
from captide.sources.store import Store

T1, T2, T3 = "2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00"
CAPTION = "WEBVTT\nKind: captions\nLanguage: en\n\n00:00:00.000 --> 00:00:01.000\nthe fox the fox\n"
INFO = {"title": "A title", "channel": "Chan", "channel_id": "C1", "upload_date": "20200406",
        "duration": 213, "view_count": 5_000_000_000}


def land(path, ids, captions=(), infos=None, fetches=None, returncode=0):
    """Write a landing directory; ids without a fetch result get exit code 0."""
    for sub in ("snapshot", "snapshot_status", "fetch_results", "files"):
        (path / sub).mkdir(parents=True)
    lines = [json.dumps({"id": i, "title": i}) for i in ids]
    (path / "snapshot" / "list.jsonl").write_text("\n".join(lines) + "\n\nnot json\n")
    (path / "snapshot_status" / "status.json").write_text(json.dumps({"returncode": returncode}))
    results = {i: (0, "") for i in ids} | (fetches or {})
    (path / "fetch_results" / "r.jsonl").write_text(
        "\n".join(
            json.dumps({"video_id": i, "returncode": c, "stderr": e, "seq": n})
            for n, (i, (c, e)) in enumerate(results.items())
        )
    )
    for i in captions:
        (path / "files" / f"{i}.en.vtt").write_text(CAPTION)
    for i, info in (infos or {}).items():
        (path / "files" / f"{i}.info.json").write_text(json.dumps(info))
    return str(path)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def rows(store, table, *columns):
    return sorted(tuple(r) for r in store.tables()[table].select(*columns).collect())


def active(store, playlist):
    members = store.tables()[MEMBERSHIP].where("removed_at is null")
    return sorted(r.video_id for r in members.where(f"playlist_id = '{playlist}'").collect())


def ingest(store, path, ids, ts=T1, playlist="PL1", **kw):
    landed = read_landing(store.spark, land(path, ids, **kw))
    return run_ingest(store, f"https://x.test/playlist?list={playlist}&si=1", landed, ts)


def refresh(store, path, ids, ts=T2, playlist="PL1", metadata=False, force=False, **kw):
    landed = read_landing(store.spark, land(path, ids, **kw))
    return run_refresh(store, playlist, landed, ts, metadata, force)


def test_ingest_loads_every_outcome(store, tmp_path):
    result = ingest(
        store,
        tmp_path / "a",
        ["v1", "v2", "v3", "v4"],
        captions=["v1"],
        infos={"v1": INFO, "v2": {}},
        fetches={"v3": (1, "ERROR: Video unavailable"), "v4": (1, "HTTP Error 429: Too Many Requests")},
    )
    assert result == {"total": 4, "existing": 0, "new": 4, "linked": 0, "ok": 1, "no_subtitles": 1, "unavailable": 1,
                      "rate_limited": 1, "status": "complete"}
    assert rows(store, VIDEOS, "video_id", "fetch_status", "title") == [
        ("v1", "ok", "A title"),
        ("v2", "no_subtitles", None),
        ("v3", "unavailable", None),
    ]
    assert active(store, "PL1") == ["v1", "v2", "v3"]
    assert rows(store, BRONZE, "video_id", "source_language", "raw_vtt") == [("v1", "en", CAPTION)]
    video = store.tables()[VIDEOS].where("video_id = 'v1'").first()
    assert (video.duration, video.view_count, str(video.upload_date)) == (213, 5_000_000_000, "2020-04-06")


def test_rate_limited_id_stays_new(store, tmp_path):
    limited = {"v1": (1, "rate limit exceeded")}
    assert ingest(store, tmp_path / "a", ["v1"], fetches=limited)["rate_limited"] == 1
    again = ingest(store, tmp_path / "b", ["v1"], ts=T2, captions=["v1"])
    assert (again["new"], again["ok"]) == (1, 1)


def test_second_ingest_only_links(store, tmp_path):
    ingest(store, tmp_path / "a", ["v1", "v2"], captions=["v1", "v2"])
    result = ingest(store, tmp_path / "b", ["v1", "v2"], ts=T2, playlist="PL2")
    assert (result["status"], result["linked"], result["new"]) == ("nothing_to_fetch", 2, 0)
    assert active(store, "PL1") == active(store, "PL2") == ["v1", "v2"]
    seen = rows(store, MEMBERSHIP, "playlist_id", "video_id", "first_seen_at")
    assert [str(r[2]) for r in seen if r[0] == "PL1"] == [T1, T1]


def test_caption_counts_as_success_whatever_the_exit_code(store, tmp_path):
    result = ingest(store, tmp_path / "a", ["v1"], captions=["v1"], fetches={"v1": (1, "429")})
    assert result["ok"] == 1


def test_unfetched_id_is_left_for_later(store, tmp_path):
    path = tmp_path / "a"
    land(path, ["v1", "v2"], captions=["v1"])
    line = {"video_id": "v1", "returncode": 0, "stderr": "", "seq": 0}
    (path / "fetch_results" / "r.jsonl").write_text(json.dumps(line))
    run_ingest(store, "PL1", read_landing(store.spark, str(path)), T1)
    assert rows(store, VIDEOS, "video_id") == [("v1",)]


@pytest.mark.parametrize("ids", [[], ["v1"]])
def test_unfinished_snapshot_stops_the_run(store, tmp_path, ids):
    with pytest.raises(IncompleteSnapshot):
        ingest(store, tmp_path / "a", ids, returncode=1)


def everything(store):
    return {t: sorted(map(str, r.collect())) for t, r in store.tables().items()}


def test_what_cannot_be_read_is_set_aside(store, tmp_path):
    """A malformed line, file or name costs its own video its data, not the run."""
    path = tmp_path / "a"
    land(path, ["v1", "v2"], captions=["v1"], infos={"v1": INFO})
    (path / "files" / "v2.info.json").write_text('{"title": ')
    (path / "files" / "v9.info.json").write_text("[]")
    (path / "files" / "no id here!.vtt").write_text(CAPTION)
    result = run_ingest(store, "PL1", read_landing(store.spark, str(path)), T1)
    assert (result["new"], result["ok"], result["no_subtitles"]) == (2, 1, 1)
    assert rows(store, VIDEOS, "video_id", "title") == [("v1", "A title"), ("v2", None)]
    aside = store.spark.read.parquet(f"{store.root}/rejected")
    assert sorted((r.source, r.name or "", r.reason) for r in aside.collect()) == [
        ("captions", "no id here!.vtt", "name"), ("infos", "v2", "malformed"), ("infos", "v9", "malformed"), ("snapshot", "", "malformed"),
    ]


def test_a_row_that_breaks_a_rule_changes_no_table(store, tmp_path, monkeypatch):
    ingest(store, tmp_path / "a", ["v1"], captions=["v1"])
    before = everything(store)
    from captide.plans import ingest as plan

    original = plan.changed_videos
    monkeypatch.setattr(
        plan, "changed_videos", lambda *a: original(*a).selectExpr("* except (fetch_status)", "'odd' fetch_status")
    )
    with pytest.raises(Exception, match="not allowed"):
        ingest(store, tmp_path / "b", ["v1", "v2"], ts=T2, captions=["v2"])
    assert everything(store) == before


def test_a_run_cut_off_between_tables_is_completed_by_the_next(store, tmp_path, monkeypatch):
    path = land(tmp_path / "a", ["v1", "v2"], captions=["v1"])
    original = Store.replace

    def cut_off(self, table, staged):
        if table == VIDEOS:
            raise RuntimeError("lost")
        original(self, table, staged)

    monkeypatch.setattr(Store, "replace", cut_off)
    with pytest.raises(RuntimeError, match="lost"):
        run_ingest(store, "PL1", read_landing(store.spark, path), T1)
    assert rows(store, BRONZE, "video_id") == [("v1",)] and rows(store, VIDEOS, "video_id") == []
    monkeypatch.setattr(Store, "replace", original)
    assert run_ingest(store, "PL1", read_landing(store.spark, path), T2)["new"] == 2
    assert rows(store, VIDEOS, "video_id", "fetch_status") == [("v1", "ok"), ("v2", "no_subtitles")]
    assert rows(store, BRONZE, "video_id") == [("v1",)] and active(store, "PL1") == ["v1", "v2"]


def test_refresh_of_an_unchanged_playlist(store, tmp_path):
    ingest(store, tmp_path / "a", ["v1", "v2"], captions=["v1", "v2"])
    result = refresh(store, tmp_path / "b", ["v1", "v2"])
    assert result == {"added": 0, "tombstoned": 0, "newly_captioned": 0, "status": "complete"}
    assert [str(r[0]) for r in rows(store, MEMBERSHIP, "last_seen_at")] == [T2, T2]


def test_removed_member_gets_a_tombstone_and_comes_back(store, tmp_path):
    ingest(store, tmp_path / "a", ["v1", "v2", "v3"], captions=["v1"])
    ingest(store, tmp_path / "p2", ["v3"], playlist="PL2")
    assert refresh(store, tmp_path / "b", ["v1", "v2"])["tombstoned"] == 1
    assert active(store, "PL1") == ["v1", "v2"]
    assert active(store, "PL2") == ["v3"]
    assert refresh(store, tmp_path / "c", ["v1", "v2", "v3"], ts=T3)["tombstoned"] == 0
    assert active(store, "PL1") == ["v1", "v2", "v3"]


def test_mass_removal_needs_an_override(store, tmp_path):
    ids = [f"v{i:02}" for i in range(25)]
    ingest(store, tmp_path / "a", ids)
    before = everything(store)
    with pytest.raises(TooManyRemovals):
        refresh(store, tmp_path / "b", ids[:1])
    assert everything(store) == before
    assert refresh(store, tmp_path / "c", ids[:1], force=True)["tombstoned"] == 24
    assert active(store, "PL1") == ids[:1]


def test_twenty_removals_are_allowed(store, tmp_path):
    ids = [f"v{i:02}" for i in range(21)]
    ingest(store, tmp_path / "a", ids)
    assert refresh(store, tmp_path / "b", ids[:1])["tombstoned"] == 20


def test_refresh_adds_retries_and_transforms(store, tmp_path):
    ingest(store, tmp_path / "a", ["old", "retry"], captions=["old"])
    result = refresh(
        store, tmp_path / "b", ["old", "retry", "fresh", "gone"],
        captions=["retry", "fresh"], fetches={"gone": (1, "Private video")},
    )
    assert result == {"added": 2, "tombstoned": 0, "newly_captioned": 2, "status": "complete"}
    assert rows(store, VIDEOS, "video_id", "fetch_status") == [
        ("fresh", "ok"), ("gone", "unavailable"), ("old", "ok"), ("retry", "ok"),
    ]
    # Only this run's captions are transformed.
    assert rows(store, SILVER, "video_id", "full_text") == [
        ("fresh", "the fox"), ("retry", "the fox"),
    ]


def test_metadata_refresh_keeps_status_and_skips_fetched(store, tmp_path):
    ingest(store, tmp_path / "a", ["v1", "v2"], captions=["v1"])
    result = refresh(
        store, tmp_path / "b", ["v1", "v2", "v3"], metadata=True,
        captions=["v2"], infos={"v1": INFO, "v3": INFO},
    )
    assert (result["updated"], result["skipped"], result["failed"]) == (1, 0, 0)
    assert rows(store, VIDEOS, "video_id", "title", "fetch_status") == [
        ("v1", "A title", "ok"), ("v2", None, "ok"), ("v3", "A title", "no_subtitles"),
    ]


def test_metadata_job(store, tmp_path):
    ingest(store, tmp_path / "a", ["v1", "v2"], infos={"v1": INFO, "v2": INFO})
    path = land(tmp_path / "b", [], infos={"v1": {"title": "New"}})
    ids = store.spark.createDataFrame([("v1",), ("v2",), ("v9",)], "video_id string")
    result = run_metadata_refresh(store, ids, read_landing(store.spark, path).infos, T2)
    assert result == {"updated": 1, "skipped": 1, "failed": 1}
    assert rows(store, VIDEOS, "video_id", "title", "channel_id", "fetch_status") == [
        ("v1", "New", None, "no_subtitles"), ("v2", "A title", "C1", "no_subtitles"),
    ]


def test_transform_modes(store, tmp_path):
    ingest(store, tmp_path / "a", ["v1", "v2", "v3"], captions=["v1", "v2", "v3"])
    ids = store.spark.createDataFrame([("v2",)], "video_id string")
    assert run_transform(store, T1, ids=ids)["processed"] == 1
    assert run_transform(store, T2)["processed"] == 2
    assert run_transform(store, T3) == {"processed": 0, "written": 0, "status": "nothing_to_process"}
    assert run_transform(store, T3, ids=ids)["processed"] == 1
    stamps = {r[0]: str(r[1]) for r in rows(store, SILVER, "video_id", "transformed_at")}
    assert stamps == {"v1": T2, "v2": T3, "v3": T2}
    assert run_transform(store, T3, ids=ids.limit(0))["processed"] == 0


def test_a_forced_run_writes_only_what_differs(store, tmp_path):
    ingest(store, tmp_path / "a", ["v1", "v2", "v3"], captions=["v1", "v2", "v3"])
    run_transform(store, T1)
    files = silver_files(store)
    assert run_transform(store, T2, force=True) == {"processed": 3, "written": 0, "status": "complete"}
    assert silver_files(store) == files
    changed = store.read(SILVER).where("video_id = 'v2'").selectExpr(
        "video_id", "'old' full_text", "source_language", "transformed_at"
    )
    store.replace(SILVER, store.staged(SILVER, changed))
    assert run_transform(store, T3, force=True)["written"] == 1
    stamps = {r[0]: str(r[1]) for r in rows(store, SILVER, "video_id", "transformed_at")}
    assert stamps == {"v1": T1, "v2": T3, "v3": T1}
    assert {r[0] for r in rows(store, SILVER, "full_text")} == {"the fox"}


def silver_files(store):
    return sorted(r[0] for r in store.read(SILVER).select("_metadata.file_path").distinct().collect())


def test_validation_report(store, tmp_path):
    ingest(store, tmp_path / "a", ["v1", "v2"], captions=["v1", "v2"])
    report = run_validate(store, T1)
    assert report["status"] == "failed"
    assert report["errors"] == ["silver count (0) != ok videos (2)"]
    run_transform(store, T2)
    report = run_validate(store, T2)
    assert (report["status"], report["errors"], report["silver_count"]) == ("ok", [], 2)
    assert set(report["artifact_hits"].values()) == {0}


def test_views_and_run_log(store, tmp_path):
    ingest(store, tmp_path / "a", ["v1"], captions=["v1"])
    store.register_views()
    query = "select v.video_id from videos v join transcripts_bronze using (video_id)"
    assert store.spark.sql(query).count() == 1
    (run,) = store.runs().collect()
    assert (run.action, run.status, run.new, run.ok, run.processed) == ("run_ingest", "complete", 1, 1, None)


def test_store_rejects_bad_rows(store, tmp_path):
    ingest(store, tmp_path / "a", ["v1"], captions=["v1"])
    spark, before = store.spark, everything(store)
    bronze = spark.createDataFrame([("v1", "x", "en")], "video_id string, raw_vtt string, source_language string")
    bronze = bronze.selectExpr("*", f"timestamp'{T1}' fetched_at")
    with pytest.raises(ConstraintViolation, match="already"):
        store.insert(BRONZE, store.staged(BRONZE, bronze))
    with pytest.raises(ConstraintViolation, match="repeated"):
        store.staged(BRONZE, bronze.union(bronze))
    with pytest.raises(Exception, match="is null"):
        store.staged(BRONZE, bronze.selectExpr("video_id", "null raw_vtt", "source_language", "fetched_at"))
    videos = store.tables()[VIDEOS].selectExpr("* except (fetch_status)", "'odd' fetch_status")
    with pytest.raises(Exception, match="not allowed"):
        store.staged(VIDEOS, videos)
    assert everything(store) == before
    # A second handle on the same root sees the same tables.
    assert everything(Store(spark, store.root)) == before


def files_of(rows):
    return {r[0]: r[1] for r in rows.select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()}


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_a_run_reads_and_writes_its_playlist_alone(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=16)
    for n in range(6):
        ingest(store, tmp_path / f"p{n}", [f"v{n}", "all"], playlist=f"PL{n}")
    plan = plan_of(store.read_members(MEMBERSHIP, "PL3"))
    part = store.partitioned(MEMBERSHIP).where("playlist_id = 'PL3'").first().part
    assert f"part#" in plan and f"= {part})" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]
    before = files_of(store.partitioned(MEMBERSHIP))
    others = {f for f in before if f"part={part}/" not in f}
    assert others and len(others) < len(before)
    refresh(store, tmp_path / "again", ["v3", "all", "more"], playlist="PL3")
    after = files_of(store.partitioned(MEMBERSHIP))
    assert {f: after.get(f) for f in others} == {f: before[f] for f in others}
    assert active(store, "PL3") == ["all", "more", "v3"] and active(store, "PL1") == ["all", "v1"]


def test_audit_reads_touched_partitions_and_finds_what_changed(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=4)
    ids = [f"v{n}" for n in range(20)]
    ingest(store, tmp_path / "a", ids)
    rows = store.partitioned(VIDEOS)
    parts = sorted(r.part for r in rows.select("part").distinct().collect())
    store.record(VIDEOS, parts)
    assert store.audit(VIDEOS, parts) == []
    first = parts[0]
    planted = stage(rows.where(f"part = {first}").limit(1), "planted")
    store._write(VIDEOS, planted, overwrite=False)
    assert store.audit(VIDEOS, parts) == [first]
    assert store.audit(VIDEOS, parts[1:]) == []
    plan = plan_of(store._in_parts(VIDEOS, parts[1:2]))
    assert "part#" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]


def test_few_ids_read_few_partitions(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=32)
    ids = [f"v{n}" for n in range(40)]
    ingest(store, tmp_path / "a", ids, captions=ids)
    listed = spark.createDataFrame([("v1",), ("v2",)], "video_id string")
    for table in (VIDEOS, BRONZE):
        found = store.read_for(table, listed)
        assert len(files_of(found)) <= 2 < len(files_of(store.read(table)))
        assert {"v1", "v2"} <= {r.video_id for r in found.collect()}
    assert store.read_for(VIDEOS, listed.limit(0)).collect() == []


def test_no_text_is_read_before_its_file_is_chosen(store, tmp_path):
    from captide.operators import diff
    from captide.plans import ingest as plan
    from captide.sources import landing

    path = tmp_path / "a"
    land(path, ["v1", "v2"], captions=["v1", "v2", "other"])
    (path / "files" / "v1.de.vtt").write_text(CAPTION + "auf Deutsch\n")
    (path / "files" / "Some title [v3] (2).vtt").write_text(CAPTION + "v3\n")
    landed = read_landing(store.spark, str(path))
    ids = store.spark.createDataFrame([("v1",), ("v3",), ("v4",)], "video_id string")
    named = store.spark.createDataFrame([("v4", "fr")], "video_id string, source_language string")
    chosen = diff.chosen_captions(ids, landed.captions, named)
    assert "raw_vtt" not in plan_of(chosen) and "value" not in plan_of(chosen)
    assert sorted((r.video_id, r.source_language) for r in chosen.collect()) == [("v1", "de"), ("v3", "en"), ("v4", "fr")]
    rows = plan.bronze_rows(chosen, landed.texts, T1)
    assert "raw_vtt" not in shuffled_columns(plan_of(rows)) and "Scan text" not in plan_of(rows)
    assert {r.video_id: r.raw_vtt for r in rows.collect()} == {
        "v1": CAPTION + "auf Deutsch\n", "v3": CAPTION + "v3\n", "v4": "",
    }
    packed = landed.captions.select("file").withColumn("raw_vtt", F.col("file"))
    joined = plan.bronze_rows(stage(chosen, "chosen"), plan.packed_texts(stage(packed, "packed")), T1)
    assert "raw_vtt" not in shuffled_columns(plan_of(joined))
    assert [r.name for r in landing.rejected_names(landed.captions).collect()] == ["Some title [v3] (2).vtt"]


def shuffled_columns(plan):
    """Everything named in a plan below its exchanges."""
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    below = []
    for at, line in enumerate(lines):
        if "Exchange" in line:
            for d, inner in zip(depth[at + 1 :], lines[at + 1 :], strict=True):
                if d <= depth[at]:
                    break
                below.append(inner)
    return "\n".join(below)


def test_stored_transcripts_are_not_shuffled(store, tmp_path):
    spark = store.spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ingest(store, tmp_path / "a", ["v1", "v2"], captions=["v1", "v2"])
        run_transform(store, T1)
        tables = store.tables()
        plan = pending_plan(tables)
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
        ingest(store, tmp_path / "b", ["v1", "v2", "v3"], captions=["v3"], ts=T2)
        run_transform(store, T2)
        plan = pending_plan(store.tables())
        assert "raw_vtt" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def pending_plan(tables):
    return plan_of(select_transcripts(tables[BRONZE], tables[SILVER]))


def test_stored_rows_survive_another_partition_setting(spark, tmp_path):
    """A store keeps the partition counts it was created with."""
    root = f"file://{tmp_path}/layout"
    rows = spark.range(300).selectExpr(
        "cast(id as string) AS video_id", "'x' AS raw_vtt", "'en' AS source_language",
        "timestamp'2024-01-01' AS fetched_at",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        store = Store(spark, root)
        store.create()
        store.insert(BRONZE, store.staged(BRONZE, rows))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for setting in ("2", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", setting)
            stored = Store(spark, root).tables()[BRONZE]
            assert stored.join(rows.select("video_id"), "video_id").count() == 300
        with pytest.raises(ValueError):
            Store(spark, root, buckets=3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


def test_an_empty_caption_is_a_caption(store, tmp_path):
    path = tmp_path / "a"
    land(path, ["v1", "v2"], captions=["v2"])
    (path / "files" / "v1.de.vtt").write_text("")
    lines = [
        {"video_id": "v1", "returncode": 0, "stderr": "", "seq": 0, "caption_files": ["v1.de.vtt"]},
        {"video_id": "v2", "returncode": 0, "stderr": "", "seq": 1, "caption_files": ["v2.en.vtt"]},
    ]
    (path / "fetch_results" / "r.jsonl").write_text("\n".join(map(json.dumps, lines)))
    result = run_ingest(store, "PL1", read_landing(store.spark, str(path)), T1)
    assert (result["ok"], result["no_subtitles"]) == (2, 0)
    assert rows(store, BRONZE, "video_id", "source_language", "raw_vtt") == [
        ("v1", "de", ""),
        ("v2", "en", CAPTION),
    ]


def test_captions_of_unscheduled_ids_are_not_stored(store, tmp_path):
    ingest(store, tmp_path / "a", ["v1"], captions=["v1", "other"])
    assert rows(store, BRONZE, "video_id") == [("v1",)]


def test_failed_fetches_are_reported(store, tmp_path):
    ingest(
        store,
        tmp_path / "a",
        ["v1", "v2"],
        captions=["v1"],
        fetches={"v1": (1, "late"), "v2": (1, "  ERROR: Video unavailable " + "x" * 200)},
    )
    logged = store.spark.read.parquet(f"{store.root}/fetch_failures").collect()
    assert [(r.video_id, r.fetch_status, len(r.detail)) for r in logged] == [("v2", "unavailable", 120)]


def test_removal_limit_is_a_parameter(store, tmp_path):
    ingest(store, tmp_path / "a", ["v1", "v2", "v3"], captions=["v1"])
    landed = read_landing(store.spark, land(tmp_path / "b", ["v1"]))
    with pytest.raises(TooManyRemovals, match="2 removals exceed 1"):
        run_refresh(store, "PL1", landed, T2, max_tombstones=1)
    assert run_refresh(store, "PL1", landed, T2, max_tombstones=2)["tombstoned"] == 2
