"""Many snapshots at once against run by run, and pages of a list against the whole list."""

import random

import pytest

from captide.operators import backfill, diff, merge, reading
from captide.plans.backfill import run_backfill
from captide.schema import MEMBERSHIP, SCHEMAS
from captide.sources.store import Store

LISTED = "playlist_id string, video_id string, at timestamp"


def moment(day):
    return f"2026-01-{day:02} 00:00:00"


def snapshots_of(seed, playlists=2, days=9, videos=12):
    numbers = random.Random(seed)
    found = {}
    for day in range(1, days + 1):
        for p in range(playlists):
            if numbers.random() < 0.85:
                ids = numbers.sample(range(videos), numbers.randint(0, videos))
                found[f"PL{p}", day] = [f"v{i}" for i in ids]
    return found


def replayed(spark, stored, snapshots):
    """Each snapshot upserted and what it lacks tombstoned, one run after another."""
    members = stored
    for (playlist, day), ids in sorted(snapshots.items(), key=lambda x: x[0][1]):
        listed = spark.createDataFrame([(i,) for i in ids], "video_id string")
        gone = diff.rows_not_in(diff.active_members(members, playlist), listed)
        marked = merge.tombstone(members, playlist, gone, moment(day))
        rows = merge.touch_membership(marked, playlist, listed, moment(day)).collect()
        members = spark.createDataFrame(rows, SCHEMAS[MEMBERSHIP])
    return sorted(map(str, members.collect()))


def table(spark, snapshots):
    rows = [(p, i, moment(day)) for (p, day), ids in snapshots.items() for i in ids]
    listed = spark.createDataFrame(rows, "playlist_id string, video_id string, at string")
    taken = spark.createDataFrame([(p, moment(d)) for p, d in snapshots], "playlist_id string, at string")
    as_time = lambda f: f.withColumn("at", f["at"].cast("timestamp"))
    listed = as_time(listed)
    return listed.union(listed.limit(3)), as_time(taken)


def test_backfill_equals_replaying_run_by_run(spark):
    snapshots = snapshots_of(3)
    listed, taken = table(spark, snapshots)
    found = backfill.backfill_membership(listed, taken).select(*SCHEMAS[MEMBERSHIP].names)
    empty = spark.createDataFrame([], SCHEMAS[MEMBERSHIP])
    assert sorted(map(str, found.collect())) == replayed(spark, empty, snapshots)


def test_spells_cover_what_was_listed_and_end_at_the_next_snapshot(spark):
    snapshots = snapshots_of(5)
    listed, taken = table(spark, snapshots)
    days = {p: sorted(d for q, d in snapshots if q == p) for p, _ in snapshots}
    seen = {(p, i): [] for (p, _), ids in snapshots.items() for i in ids}
    for (p, day), ids in sorted(snapshots.items(), key=lambda x: x[0][1]):
        for i in ids:
            seen[p, i].append(days[p].index(day))
    expected = set()
    for (p, i), at in seen.items():
        start = at[0]
        for here, following in zip(at, [*at[1:], None], strict=True):
            if following != here + 1:
                after = days[p][here + 1] if here + 1 < len(days[p]) else None
                expected.add((p, i, days[p][start], days[p][here], after))
                start = following
    found = backfill.membership_spells(listed, taken).collect()
    assert {(r[0], r[1], r[2].day, r[3].day, r[4] and r[4].day) for r in found} == expected
    assert len(found) == len(expected)


def test_stored_members_are_brought_up_to_date(spark):
    early, late = snapshots_of(7, days=5), snapshots_of(8, days=4)
    late = {("PL0", day + 10): ids for (p, day), ids in late.items() if p == "PL0"} | {("PL0", 10): []}
    empty = spark.createDataFrame([], SCHEMAS[MEMBERSHIP])
    listed, taken = table(spark, early)
    stored = backfill.backfill_membership(listed, taken).select(*SCHEMAS[MEMBERSHIP].names)
    found = backfill.resumed_membership(stored, *table(spark, late))
    found = found.select(*SCHEMAS[MEMBERSHIP].names)
    assert sorted(map(str, found.collect())) == replayed(spark, empty, early | late)


def test_backfill_job_writes_its_playlists_alone(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), buckets=8)
    early, late = snapshots_of(7, days=5), {("PL1", 12): ["v1", "v90"]}
    assert run_backfill(store, *table(spark, early), moment(6))["playlists"] == 2
    before = store.read(MEMBERSHIP).where("playlist_id = 'PL0'").select("_metadata.file_path").distinct().collect()
    run_backfill(store, *table(spark, late), moment(13))
    empty = spark.createDataFrame([], SCHEMAS[MEMBERSHIP])
    assert sorted(map(str, store.read(MEMBERSHIP).collect())) == replayed(spark, empty, early | late)
    after = store.read(MEMBERSHIP).where("playlist_id = 'PL0'").select("_metadata.file_path").distinct().collect()
    assert before == after


def test_no_snapshot_gives_no_member(spark):
    nothing = spark.createDataFrame([], LISTED)
    assert backfill.backfill_membership(nothing).collect() == []


@pytest.fixture(scope="module")
def videos(spark):
    numbers = random.Random(1)
    days = [None, "2026-01-01", "2026-01-01", "2026-01-02", "2026-01-05"]
    rows = [(f"{numbers.choice('abA-_é')}{numbers.choice('xyz')}{i}", numbers.choice(days), "c") for i in range(300)]
    frame = spark.createDataFrame(rows, "video_id string, upload_date string, channel_name string")
    return frame.withColumn("upload_date", frame["upload_date"].cast("date"))


def in_order(videos):
    rows = videos.collect()
    rows.sort(key=lambda r: r.video_id.encode())
    return sorted(rows, key=lambda r: (r.upload_date is None, -(r.upload_date.toordinal() if r.upload_date else 0)))


@pytest.mark.parametrize("page", [1, 2, 9, 17, 25, 31, 60])
def test_far_pages_are_those_of_the_whole_list(videos, page):
    found = reading.browse(videos, page=page, page_size=10, most=5).collect()
    assert found == in_order(videos)[(page - 1) * 10 : page * 10]


def test_a_far_page_sorts_few_rows(videos):
    rows, left = reading.rows_from(videos, 200, most=5)
    assert left <= 5 and rows.count() <= 105


def test_a_cursor_walks_the_whole_list(videos):
    whole, seen = in_order(videos), []
    page = reading.browse(videos, page_size=70).collect()
    while page:
        seen += page
        last = page[-1]
        page = reading.browse_after(videos, last.upload_date and str(last.upload_date), last.video_id, 70).collect()
    assert seen == whole
