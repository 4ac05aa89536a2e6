"""Queries over whole benchmark tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.functions import outcomes as O
from captide.functions import text as X
from captide.operators import backfill, diff, merge, quality, reading, summaries
from captide.plans import ingest, refresh, transform
from captide.schema import BRONZE, MEMBERSHIP, SILVER, VIDEOS
from captide.sources import landing
from captide.suite import inputs as I

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Rows of a part of a table dealt out.
_PART_ROWS = 4000


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def stamped(rows: DataFrame) -> DataFrame:
    """Timestamps as text, so that results compare the same in every client."""
    return rows.select(
        *[
            F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)
            if kind == "timestamp"
            else F.col(name)
            for name, kind in rows.dtypes
        ]
    )


def spread(rows: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Rows dealt to all cores before expensive text work, and to more parts as they grow in number.

    The benchmark tables are single files of one row group, which one task would read and
    clean; stored transcripts come in many partitions and need no such step.  A Python
    worker holds up to two batches of its part, so parts of few rows keep it small.  ``of``
    is a plain table that has no fewer rows, where to count ``rows`` would be work.
    """
    parts = -(-(rows if of is None else of).count() // _PART_ROWS)
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, parts))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "documents")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "pages")


# -- caption text ------------------------------------------------------------------


@query
def collapse_phrases(spark, sf_dir):
    return spread(documents(spark, sf_dir)).select(
        "doc_id", X.collapse_phrases(F.col("text")).alias("full_text")
    )


@query
def phrase_stats_by_lang(spark, sf_dir):
    """Words before and after phrase collapse, per language."""
    return (
        spread(documents(spark, sf_dir))
        .select("lang", X.normalise_spaces(F.col("text")).alias("before"))
        .withColumn("after", X.collapse_words(F.col("before")))
        .groupBy("lang")
        .agg(
            F.count("*").alias("n_docs"),
            F.count_if(F.col("before") != F.col("after")).alias("n_changed"),
            F.sum(X.word_count(F.col("before"))).alias("words_before"),
            F.sum(X.word_count(F.col("after"))).alias("words_after"),
        )
    )


@query
def strip_markup(spark, sf_dir):
    rows = spread(I.captions(spark, sf_dir))
    return rows.select("video_id", X.strip_markup(F.col("raw_vtt")).alias("plain"))


@query
def clean_captions(spark, sf_dir):
    rows = spread(I.captions(spark, sf_dir))
    return rows.select("video_id", X.clean_captions(F.col("raw_vtt")).alias("prose"))


@query
def clean_pages(spark, sf_dir):
    return spread(pages(spark, sf_dir)).select("page_id", X.clean_captions(F.col("html")).alias("prose"))


@query
def page_transcripts(spark, sf_dir):
    """Cleaning and collapse of texts with entities, tags and arrows."""
    return spread(pages(spark, sf_dir)).select(
        "page_id", X.transcript_text(F.col("html")).alias("full_text")
    )


# -- outcomes and fields ----------------------------------------------------------


@query
def classify_failures(spark, sf_dir):
    status = O.classify_failure(F.col("returncode"), F.col("stderr"))
    return I.fetches(spark, sf_dir).select("seq", status.alias("fetch_status"))


@query
def error_details(spark, sf_dir):
    """Start of long padded error texts."""
    padded = F.concat(F.lit(" \t"), F.repeat(F.concat("stderr", F.lit(" again ")), 20))
    return I.fetches(spark, sf_dir).select("seq", O.error_detail(padded).alias("detail"))


@query
def playlist_ids(spark, sf_dir):
    """Page numbers as list parameters; many addresses have none."""
    url = F.replace(F.col("url"), F.lit("page="), F.lit("list="))
    return pages(spark, sf_dir).select("page_id", O.playlist_id(url).alias("playlist_id"))


@query
def upload_dates(spark, sf_dir):
    """Event days as compact dates, some impossible, short or spoilt by event type."""
    kind = F.col("event_type")
    day = F.date_format("ts", "yyyyMMdd")
    text = (
        F.when(kind == "error", F.replace(day, F.lit("202401"), F.lit("202402")))
        .when(kind == "view", F.replace(day, F.lit("20240"), F.lit("2024")))
        .when(kind == "signup", F.concat(F.lit("x"), day))
        .otherwise(day)
    )
    return I.table(spark, sf_dir, "events").select(
        "event_id", text.alias("raw"), O.compact_date(text).alias("upload_date")
    )


@query
def metadata_fallback(spark, sf_dir):
    """Channel unless blank or missing, else uploader."""
    channel = F.when(F.col("c_acctbal") < 0, "").when(F.col("c_acctbal") < 5000, F.col("c_name"))
    return I.table(spark, sf_dir, "customer").select(
        "c_custkey", O.first_filled(channel, F.col("c_mktsegment")).alias("channel_name")
    )


@query
def metadata_files(spark, sf_dir):
    return landing.parse_infos(I.info_texts(spark, sf_dir))


@query
def snapshot_lines(spark, sf_dir):
    """Ids from JSON lines of which some are blank, cut short or without an id."""
    kind, props = F.col("event_type"), F.col("props")
    line = (
        F.when(kind == "error", F.substring(props, 1, 6))
        .when(kind == "view", "")
        .when(kind == "signup", props)
        .otherwise(F.replace(props, F.lit('"k"'), F.lit('"id"')))
    )
    lines = I.table(spark, sf_dir, "events").select(line.alias("value"))
    return landing.snapshot_ids(lines).groupBy("video_id").agg(F.count("*").alias("n_lines"))


@query
def caption_names(spark, sf_dir):
    """Video and language from caption file names, some without a language."""
    suffix = F.when(F.col("source") == "src0", ".vtt").otherwise(
        F.concat(F.lit("."), "lang", F.lit("-"), "source", F.lit(".vtt"))
    )
    name = F.concat(F.col("doc_id").cast("string"), suffix)
    return I.table(spark, sf_dir, "documents").select(
        landing.caption_name(name).alias("n")
    ).select("n.*")


@query
def first_captions(spark, sf_dir):
    """One caption per source when many files landed for it."""
    files = I.table(spark, sf_dir, "documents").select(
        F.col("source").alias("video_id"),
        F.concat("lang", F.lit("-"), F.lpad(F.col("doc_id").cast("string"), 12, "0"))
        .alias("source_language"),
        F.col("text").alias("raw_vtt"),
    )
    return diff.first_captions(files)


# -- selection ----------------------------------------------------------------------


def _selected(spark, sf_dir, **mode) -> DataFrame:
    rows = transform.select_transcripts(
        I.transcripts_bronze(spark, sf_dir), I.transcripts_silver(spark, sf_dir), **mode
    )
    return rows.select("video_id", F.length("raw_vtt").cast("bigint").alias("n_chars"))


@query
def pending_transcripts(spark, sf_dir):
    return _selected(spark, sf_dir)


@query
def scoped_transcripts(spark, sf_dir):
    return _selected(spark, sf_dir, ids=I.playlist_snapshot(spark, sf_dir), force=True)


@query
def forced_transcripts(spark, sf_dir):
    return _selected(spark, sf_dir, force=True)


# -- differences --------------------------------------------------------------------


def _labels(spark, sf_dir, since=I.SNAPSHOT_FROM) -> DataFrame:
    return diff.label_snapshot(
        I.playlist_snapshot(spark, sf_dir, since),
        diff.members_of(I.membership(spark, sf_dir), I.PLAYLIST),
        I.videos(spark, sf_dir),
    )


@query
def snapshot_labels(spark, sf_dir):
    return _labels(spark, sf_dir)


@query
def diff_counts(spark, sf_dir):
    return summaries.diff_counts(_labels(spark, sf_dir))


@query
def tombstone_check(spark, sf_dir):
    """A recent, therefore short, snapshot next to a longer one."""
    return (
        summaries.tombstone_check(_labels(spark, sf_dir))
        .withColumn("since", F.lit(I.SNAPSHOT_FROM))
        .union(
            summaries.tombstone_check(_labels(spark, sf_dir, I.MEMBERS_UNTIL)).withColumn(
                "since", F.lit(I.MEMBERS_UNTIL)
            )
        )
    )


@query
def new_ids(spark, sf_dir):
    snapshot = I.playlist_snapshot(spark, sf_dir)
    return diff.with_known(snapshot, I.videos(spark, sf_dir)).where("not known").select("video_id")


@query
def linked_ids(spark, sf_dir):
    snapshot = I.playlist_snapshot(spark, sf_dir)
    return diff.with_known(snapshot, I.videos(spark, sf_dir)).where("known").select("video_id")


@query
def tombstone_ids(spark, sf_dir):
    active = diff.active_members(I.membership(spark, sf_dir), I.PLAYLIST)
    return diff.rows_not_in(active, I.playlist_snapshot(spark, sf_dir))


@query
def retry_ids(spark, sf_dir):
    return diff.awaiting_captions(I.videos(spark, sf_dir), I.playlist_snapshot(spark, sf_dir))


@query
def touch_ids(spark, sf_dir):
    return diff.with_label(_labels(spark, sf_dir), diff.TOUCH)


@query
def scheduled_ids(spark, sf_dir):
    """Union of the new and the retried ids."""
    return new_ids(spark, sf_dir).union(retry_ids(spark, sf_dir)).distinct()


@query
def active_members(spark, sf_dir):
    return diff.active_members(I.membership(spark, sf_dir), I.PLAYLIST)


def _chosen(spark, sf_dir, ids: DataFrame) -> DataFrame:
    """Caption files of listed ids, by name; every customer's fetch names a Finnish one."""
    customers = I.table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'")
    empty = customers.select(F.col("c_custkey").cast("string").alias("video_id"), F.lit("fi").alias("source_language"))
    return diff.chosen_captions(ids, I.caption_names(spark, sf_dir), empty)


def _run(spark, sf_dir, *wanted: str) -> tuple[DataFrame, DataFrame]:
    """Labels, and outcomes of the ids with the wanted ones."""
    labels = _labels(spark, sf_dir)
    ids = diff.with_label(labels, *wanted)
    infos = landing.parse_infos(I.info_texts(spark, sf_dir))
    return labels, diff.assemble_outcomes(ids, I.fetches(spark, sf_dir), _chosen(spark, sf_dir, ids), infos)


@query
def resolved_outcomes(spark, sf_dir):
    """Outcome, caption presence and metadata of the scheduled ids."""
    return _run(spark, sf_dir, diff.NEW, diff.RETRY)[1].drop("seq")


@query
def recorded_outcomes(spark, sf_dir):
    """Fetches of all listed ids except the rate-limited ones."""
    scheduled = _run(spark, sf_dir, diff.NEW, diff.RETRY, diff.TOUCH)[1]
    return diff.writable(scheduled).select("video_id", "fetch_status")


@query
def outcome_tally(spark, sf_dir):
    status = O.classify_failure(F.col("returncode"), F.col("stderr")).alias("fetch_status")
    return summaries.outcome_tally(I.fetches(spark, sf_dir).select(status))


@query
def captioned_ids(spark, sf_dir):
    """Ids of both fetch batches that brought a caption."""
    outcomes = _run(spark, sf_dir, diff.NEW, diff.RETRY)[1]
    return outcomes.where("has_caption").select("video_id")


# -- merges -------------------------------------------------------------------------


@query
def upsert_videos(spark, sf_dir):
    return stamped(
        merge.upsert_videos(
            I.customer_videos(spark, sf_dir), I.order_outcomes(spark, sf_dir), I.RUN_TS
        )
    )


@query
def update_metadata(spark, sf_dir):
    return stamped(
        merge.update_metadata(I.customer_videos(spark, sf_dir), I.order_outcomes(spark, sf_dir))
    )


@query
def insert_transcripts(spark, sf_dir):
    """First order of each customer inserted where the customer is not stored yet."""
    source = I.order_outcomes(spark, sf_dir).select("video_id", "title", "fetch_status", "seq")
    target = I.customer_videos(spark, sf_dir).select("video_id", "title", "fetch_status")
    return merge.insert_only(target, source)


@query
def upsert_membership(spark, sf_dir):
    """All late events seen now, as members of all playlists."""
    late = I.events(spark, sf_dir).where(F.col("ts") >= I.day(I.SNAPSHOT_FROM))
    source = late.select(F.col("event_type").alias("playlist_id"), "video_id")
    return stamped(merge.upsert_membership(I.membership(spark, sf_dir), source, I.RUN_TS))


@query
def touch_membership(spark, sf_dir):
    ids = I.playlist_snapshot(spark, sf_dir)
    members = I.membership(spark, sf_dir)
    return stamped(merge.touch_membership(members, I.PLAYLIST, ids, I.RUN_TS))


@query
def tombstone_members(spark, sf_dir):
    members, gone = I.membership(spark, sf_dir), tombstone_ids(spark, sf_dir)
    return stamped(merge.tombstone(members, I.PLAYLIST, gone, I.RUN_TS))


@query
def count_removed(spark, sf_dir):
    members, gone = I.membership(spark, sf_dir), tombstone_ids(spark, sf_dir)
    after = merge.tombstone(members, I.PLAYLIST, gone, I.RUN_TS)
    return merge.count_removed(after, I.PLAYLIST, gone)


@query
def replace_silver(spark, sf_dir):
    """Documents of one language rewritten in lower case."""
    rows = I.table(spark, sf_dir, "documents").where("lang = 'fr'")
    rows = rows.select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.lower("text").alias("full_text"),
        F.col("lang").alias("source_language"),
        F.lit(I.RUN_TS).cast("timestamp").alias("transformed_at"),
    )
    return stamped(merge.replace_rows(I.transcripts_silver(spark, sf_dir), rows))


def _daily(spark, sf_dir) -> DataFrame:
    """Each day's users of an event type, as daily snapshots of a playlist."""
    day = F.date_trunc("day", "ts").cast("timestamp").alias("at")
    return I.events(spark, sf_dir).select(F.col("event_type").alias("playlist_id"), "video_id", day)


@query
def membership_spells(spark, sf_dir):
    """Every unbroken run of days on which a playlist listed a video."""
    return stamped(backfill.membership_spells(_daily(spark, sf_dir)))


@query
def backfill_membership(spark, sf_dir):
    """The members after all days, in one pass."""
    return stamped(backfill.backfill_membership(_daily(spark, sf_dir)))


@query
def resumed_membership(spark, sf_dir):
    """Stored members brought up to date by the days of three playlists."""
    daily = _daily(spark, sf_dir).where((F.col("at") >= I.MEMBERS_UNTIL) & F.col("playlist_id").isin("click", "view", "error"))
    return stamped(backfill.resumed_membership(I.membership(spark, sf_dir), daily))


# -- summaries ----------------------------------------------------------------------


@query
def ingest_summary(spark, sf_dir):
    return summaries.ingest_summary(*_run(spark, sf_dir, diff.NEW))


@query
def refresh_summary(spark, sf_dir):
    return summaries.refresh_summary(*_run(spark, sf_dir, diff.NEW, diff.RETRY))


@query
def metadata_summary(spark, sf_dir):
    """Every customer that ordered, against stored customers and metadata files."""
    ids = I.order_outcomes(spark, sf_dir).select("video_id").distinct()
    infos = landing.parse_infos(I.info_texts(spark, sf_dir))
    return summaries.metadata_summary(ids, I.customer_videos(spark, sf_dir), infos)


@query
def transform_summary(spark, sf_dir):
    return summaries.transform_summary(pending_transcripts(spark, sf_dir))


# -- audits -------------------------------------------------------------------------


def _audited(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored customers, raw captions, and pages posing as cleaned text."""
    silver = spread(pages(spark, sf_dir)).select(
        F.col("page_id").cast("string").alias("video_id"),
        F.when(F.length("url") < 30, " ").otherwise(F.col("html")).alias("full_text"),
    )
    return I.videos(spark, sf_dir), I.transcripts_bronze(spark, sf_dir), silver


@query
def count_parity(spark, sf_dir):
    return quality.count_parity(*_audited(spark, sf_dir))


@query
def validation_report(spark, sf_dir):
    report = quality.validation_report(*_audited(spark, sf_dir))
    return report.withColumn("errors", F.array_join("errors", "; "))


@query
def artifact_audit(spark, sf_dir):
    """Leftovers in captions that were not cleaned."""
    raw = spread(I.captions(spark, sf_dir))
    return quality.artifact_audit(raw.select(F.col("raw_vtt").alias("full_text")))


@query
def cleaned_artifact_audit(spark, sf_dir):
    """The same captions after cleaning."""
    raw = spread(I.captions(spark, sf_dir))
    return quality.artifact_audit(raw.select(X.transcript_text(F.col("raw_vtt")).alias("full_text")))


@query
def constraint_audit(spark, sf_dir):
    """Orders as if they were the videos table: repeated keys, missing and odd values."""
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    rows = I.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("video_id"),
        F.when(status == "F", "ok").otherwise(status).alias("fetch_status"),
        F.col("o_orderdate").alias("ingested_at"),
    )
    return quality.constraint_audit(VIDEOS, rows)


def _orders_in_parts(spark, sf_dir) -> DataFrame:
    orders = I.table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("video_id"), F.pmod("o_custkey", F.lit(16)).cast("int").alias("part")
    )


@query
def partition_fingerprints(spark, sf_dir):
    """Keys and order-free marks per partition of the orders."""
    return quality.partition_fingerprints(VIDEOS, _orders_in_parts(spark, sf_dir))


@query
def changed_partitions(spark, sf_dir):
    """Partitions with a planted repeat, a lost key and another key; the rest are as before."""
    rows = _orders_in_parts(spark, sf_dir)
    repeated = rows.where("part = 3")
    other = F.when(F.col("part") == 5, F.concat("video_id", F.lit("x"))).otherwise(F.col("video_id"))
    after = rows.where("part <> 7").withColumn("video_id", other).unionByName(repeated)
    before, now = (quality.partition_fingerprints(VIDEOS, r) for r in (rows, after))
    return quality.changed_partitions(before, now)


# -- jobs ---------------------------------------------------------------------------


@query
def ingest_videos(spark, sf_dir):
    videos, (_, outcomes) = I.videos(spark, sf_dir), _run(spark, sf_dir, diff.NEW)
    changed = ingest.changed_videos(videos, outcomes, I.RUN_TS)
    return stamped(merge.replace_rows(videos, changed))


@query
def ingest_membership(spark, sf_dir):
    labels, outcomes = _run(spark, sf_dir, diff.NEW)
    seen = ingest.seen_ids(labels, outcomes, diff.RETRY, diff.TOUCH)
    members = I.membership(spark, sf_dir)
    of_playlist = diff.members_of(members, I.PLAYLIST)
    changed = ingest.changed_members(of_playlist, I.PLAYLIST, seen, I.RUN_TS)
    return stamped(merge.replace_rows(members, changed, merge.MEMBER_KEY))


@query
def chosen_captions(spark, sf_dir):
    """One caption file for every event's user, by name alone."""
    return _chosen(spark, sf_dir, I.events(spark, sf_dir))


@query
def ingest_bronze(spark, sf_dir):
    """Captions of every event's user; labelled documents count as loaded before.

    Files are chosen by name, and only their texts are read.
    """
    wanted = ingest.wanted_captions(I.transcripts_silver(spark, sf_dir), chosen_captions(spark, sf_dir))
    texts = ingest.packed_texts(I.caption_texts(spark, sf_dir))
    return stamped(ingest.bronze_rows(wanted, texts, I.RUN_TS))


@query
def refresh_videos(spark, sf_dir):
    """New and retried ids applied, then the metadata of the touched ones."""
    videos = I.videos(spark, sf_dir)
    labels, outcomes = _run(spark, sf_dir, diff.NEW, diff.RETRY)
    infos = landing.parse_infos(I.info_texts(spark, sf_dir))
    fetched = ingest.changed_videos(videos, outcomes, I.RUN_TS)
    touched = merge.update_metadata(videos, refresh.metadata_source(labels, infos))
    return stamped(merge.replace_rows(touched, fetched))


@query
def refresh_membership(spark, sf_dir):
    members = I.membership(spark, sf_dir)
    labels, outcomes = _run(spark, sf_dir, diff.NEW, diff.RETRY)
    changed = ingest.changed_members(
        diff.members_of(members, I.PLAYLIST),
        I.PLAYLIST,
        ingest.seen_ids(labels, outcomes, diff.TOUCH),
        I.RUN_TS,
        gone=diff.with_label(labels, diff.TOMBSTONE),
    )
    return stamped(merge.replace_rows(members, changed, merge.MEMBER_KEY))


@query
def transform_captions(spark, sf_dir):
    """Every caption cleaned and collapsed."""
    return stamped(transform.silver_rows(spread(I.transcripts_bronze(spark, sf_dir)), I.RUN_TS))


@query
def refresh_silver(spark, sf_dir):
    """Silver after transforming the pending captions."""
    silver = I.transcripts_silver(spark, sf_dir)
    pending = transform.select_transcripts(I.transcripts_bronze(spark, sf_dir), silver)
    return stamped(merge.replace_rows(silver, transform.silver_rows(spread(pending, documents(spark, sf_dir)), I.RUN_TS)))


# -- reading ------------------------------------------------------------------------


@query
def gold_documents(spark, sf_dir):
    return reading.gold_documents(
        I.transcripts_silver(spark, sf_dir), I.customer_videos(spark, sf_dir)
    )


@query
def browse_videos(spark, sf_dir):
    """Third page of a channel's videos in a date range."""
    return stamped(
        reading.browse(
            I.videos(spark, sf_dir),
            channel="by click",
            uploaded_from="2024-01-01",
            uploaded_to="2024-01-03",
            page=3,
            page_size=5,
        )
    )


@query
def browse_far(spark, sf_dir):
    """A page from the middle of the orders, most of which share their upload dates."""
    orders = I.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("video_id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_trunc("year", "o_orderdate").cast("date")).alias("upload_date"),
        F.col("o_orderstatus").alias("title"),
    )
    return reading.browse(orders, page=701, page_size=10, most=20)


@query
def browse_after(spark, sf_dir):
    """The page after a given video, without counting what comes before it."""
    return stamped(reading.browse_after(I.customer_videos(spark, sf_dir), "2020-01-01", "5", page_size=20))


@query
def rejected_lines(spark, sf_dir):
    """Snapshot lines and metadata files that could not be read, by reason."""
    kind, props = F.col("event_type"), F.col("props")
    line = (
        F.when(kind == "error", F.substring(props, 1, 6))
        .when(kind == "view", " ")
        .when(kind == "signup", props)
        .otherwise(F.replace(props, F.lit('"k"'), F.lit('"id"')))
    )
    lines = landing.snapshot_lines(I.table(spark, sf_dir, "events").select(line.alias("value")))
    cut = F.when(F.length("value") % 7 == 0, F.substring("value", 1, 20)).otherwise(F.col("value"))
    infos = landing.split_infos(I.info_texts(spark, sf_dir).withColumn("value", cut))
    both = lines.select(F.lit("snapshot").alias("source"), "reason").unionByName(
        infos.select(F.lit("infos").alias("source"), "reason")
    )
    return both.groupBy("source", F.coalesce("reason", F.lit("read")).alias("reason")).agg(F.count("*").alias("n"))


@query
def snapshot_completeness(spark, sf_dir):
    """Exit codes of listings: those of all events, and those of the events that ended well."""
    statuses = I.fetches(spark, sf_dir).select("returncode", "stderr", "seq")
    kinds = {"all": statuses, "good": statuses.where("returncode = 0"), "none": statuses.where("seq < 0")}
    rows = [landing.completeness(s).withColumn("kind", F.lit(k)).drop("stderr") for k, s in kinds.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def validation_ok(spark, sf_dir):
    """The report of clean tables: every document once, as plain words."""
    words = F.regexp_replace("text", "[^A-Za-z]+", " ")
    silver = documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("video_id"), F.concat(F.lit("x "), words).alias("full_text")
    )
    videos = silver.select("video_id", F.lit("ok").alias("fetch_status"))
    bronze = silver.select("video_id", F.col("full_text").alias("raw_vtt"))
    report = quality.validation_report(videos, bronze, silver)
    return report.withColumn("errors", F.array_join("errors", "; "))


@query
def rewritten_silver(spark, sf_dir):
    """Rows of a forced run whose result differs from the stored one: texts not lower case before."""
    silver = I.transcripts_silver(spark, sf_dir)
    rows = I.captions(spark, sf_dir).select(
        "video_id", "source_language", F.lower(F.element_at(F.split("raw_vtt", "</c>\n", -1), -1)).alias("full_text")
    )
    lowered = silver.select("video_id", F.lower("full_text").alias("full_text"), "source_language").unionByName(
        rows.join(silver.select("video_id"), "video_id", "left_anti")
    )
    return transform.with_difference(silver, lowered).where("differs").select("video_id", "source_language")


@query
def transcript_detail(spark, sf_dir):
    return stamped(reading.transcript(I.transcripts_silver(spark, sf_dir), "0"))


@query
def sql_access(spark, sf_dir):
    """Channel activity in plain SQL over views of the tables."""
    views = {
        VIDEOS: I.videos,
        MEMBERSHIP: I.membership,
        BRONZE: I.transcripts_bronze,
        SILVER: I.transcripts_silver,
    }
    for name, build in views.items():
        build(spark, sf_dir).createOrReplaceTempView(name)
    return spark.sql(
        f"""
        SELECT v.channel_name, m.playlist_id, count(*) AS n_members,
               count_if(m.removed_at IS NULL) AS n_active,
               count(b.video_id) AS n_bronze, count(s.video_id) AS n_silver
        FROM {MEMBERSHIP} m
        JOIN {VIDEOS} v USING (video_id)
        LEFT JOIN {BRONZE} b USING (video_id)
        LEFT JOIN {SILVER} s USING (video_id)
        GROUP BY v.channel_name, m.playlist_id
        """
    )
