"""The pipeline's tables and landing data, derived by Spark from the benchmark tables.

Events play snapshots, memberships and fetch outcomes; documents play caption
files; customers and orders play videos and metadata updates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.sources import landing
from captide.sources.landing import json_object

RUN_TS = "2024-02-01 00:00:00"
SNAPSHOT_FROM = "2024-01-28"
MEMBERS_UNTIL = "2024-01-20"
LAPSED_BEFORE = "2024-01-12"
KNOWN_UNTIL = "2024-01-04"
PLAYLIST = "purchase"

# One caption cue per line of text, the line shown twice as rolling captions do.
_CUE = (
    "concat('00:00:', right(concat('0', i), 2), '.000 --> 00:00:', right(concat('0', i), 2), "
    "'.500 align:start position:0%\n', '<00:00:01.120><c> ', l, '</c>\n', l)"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.withColumn("video_id", F.col("user_id").cast("string"))


def day(text: str):
    return F.lit(text).cast("timestamp_ntz")


def playlist_snapshot(spark: SparkSession, sf_dir: str, since: str = SNAPSHOT_FROM) -> DataFrame:
    return (
        events(spark, sf_dir)
        .where((F.col("event_type") == PLAYLIST) & (F.col("ts") >= day(since)))
        .select("video_id")
    )


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    lapsed = F.max("ts") < day(LAPSED_BEFORE)
    return (
        events(spark, sf_dir)
        .where(F.col("ts") < day(MEMBERS_UNTIL))
        .groupBy(F.col("event_type").alias("playlist_id"), "video_id")
        .agg(
            F.min("ts").cast("timestamp").alias("first_seen_at"),
            F.max("ts").cast("timestamp").alias("last_seen_at"),
            F.when(lapsed, F.max("ts")).cast("timestamp").alias("removed_at"),
        )
    )


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users that signed up early, with a status from their last event before the cut."""
    last = F.max_by(F.struct("event_type", "value", "event_id"), F.struct("ts", "event_id"))
    users = (
        events(spark, sf_dir)
        .where(F.col("ts") < day(MEMBERS_UNTIL))
        .groupBy("video_id")
        .agg(
            last.alias("last"),
            F.min(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("signed_up"),
        )
        .where(F.col("signed_up") < day(KNOWN_UNTIL))
    )
    kind = F.col("last.event_type")
    return users.select(
        "video_id",
        F.concat(F.lit("Video "), "video_id").alias("title"),
        F.concat(F.lit("by "), kind).alias("channel_name"),
        kind.alias("channel_id"),
        F.col("signed_up").cast("date").alias("upload_date"),
        F.floor("last.value").cast("int").alias("duration"),
        F.col("last.event_id").alias("view_count"),
        F.when(kind == "error", "unavailable")
        .when(kind == "view", "no_subtitles")
        .otherwise("ok")
        .alias("fetch_status"),
        F.col("signed_up").cast("timestamp").alias("ingested_at"),
    )


def fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a fetch attempt with an exit code and an error text."""
    kind = F.col("event_type")
    http_code = 400 + json_object(F.col("props"), "k int")["k"]
    return events(spark, sf_dir).select(
        "video_id",
        F.when(kind.isin("error", "view", "signup"), 1).otherwise(0).alias("returncode"),
        F.when(kind == "view", F.concat(F.lit(" There are No Subtitles for "), "video_id"))
        .when(kind == "error", F.concat(F.lit("\tHTTP Error "), http_code.cast("string")))
        .when(kind == "signup", "boom")
        .otherwise("")
        .alias("stderr"),
        F.col("event_id").alias("seq"),
    )


def raw_caption(text: str, lang: str):
    """A text column in caption file form."""
    cues = f"array_join(transform(split({text}, '\n'), (l, i) -> {_CUE}), '\n')"
    return F.expr(f"concat('WEBVTT\nKind: captions\nLanguage: ', {lang}, '\n\n', {cues})")


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.col("lang").alias("source_language"),
        raw_caption("text", "lang").alias("raw_vtt"),
    )


def caption_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The captions by name; those of one source in ten are named oddly, with the id as a word."""
    documents = table(spark, sf_dir, "documents")
    doc = F.col("doc_id").cast("string")
    plain = F.concat(doc, F.lit("."), "lang", F.lit(".vtt"))
    odd = F.concat(F.lit("A title ["), doc, F.lit("].vtt"))
    name = F.when(F.col("source") == "src1", odd).otherwise(plain)
    return landing.caption_names(documents.select(name.alias("name"), doc.alias("file")))


def caption_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions(spark, sf_dir).select(F.col("video_id").alias("file"), "raw_vtt")


def transcripts_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captions(spark, sf_dir).withColumn(
        "fetched_at", F.lit(MEMBERS_UNTIL).cast("timestamp")
    )


def transcripts_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents, as rows processed earlier."""
    labelled = table(spark, sf_dir, "labels").select("doc_id")
    documents = table(spark, sf_dir, "documents").join(labelled, "doc_id", "left_semi")
    return documents.select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.col("text").alias("full_text"),
        F.col("lang").alias("source_language"),
        F.lit(MEMBERS_UNTIL).cast("timestamp").alias("transformed_at"),
    )


def info_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as metadata JSON; large balances lack a channel, negative ones all keys."""
    customers = table(spark, sf_dir, "customer")
    filled = F.to_json(
        F.struct(
            F.col("c_name").alias("title"),
            F.when(F.col("c_acctbal") < 5000, F.col("c_mktsegment")).otherwise("").alias("channel"),
            F.concat(F.lit("up "), F.col("c_mktsegment")).alias("uploader"),
            F.when(F.col("c_acctbal") < 5000, F.col("c_nationkey").cast("string"))
            .alias("channel_id"),
            F.lit("UP").alias("uploader_id"),
            F.concat(F.lit("202001"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"))
            .alias("upload_date"),
            (F.col("c_nationkey") * 10).alias("duration"),
            (F.col("c_custkey") * 1000000).alias("view_count"),
        )
    )
    return customers.select(
        F.col("c_custkey").cast("string").alias("video_id"),
        F.when(F.col("c_acctbal") < 0, "{}").otherwise(filled).alias("value"),
    )


def customer_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in credit, as stored videos."""
    customers = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    return customers.select(
        F.col("c_custkey").cast("string").alias("video_id"),
        F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("channel_name"),
        F.col("c_nationkey").cast("string").alias("channel_id"),
        F.lit("2020-01-01").cast("date").alias("upload_date"),
        F.col("c_nationkey").cast("int").alias("duration"),
        F.col("c_custkey").alias("view_count"),
        F.lit("no_subtitles").alias("fetch_status"),
        F.lit(MEMBERS_UNTIL).cast("timestamp").alias("ingested_at"),
    )


def order_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as outcomes per customer, many per key; urgent ones carry metadata."""
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    return orders.select(
        F.col("o_custkey").cast("string").alias("video_id"),
        F.when(status == "F", "ok").when(status == "O", "unavailable").otherwise("rate_limited")
        .alias("fetch_status"),
        (F.col("o_orderpriority") == "1-URGENT").alias("has_info"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("channel_name"),
        status.alias("channel_id"),
        F.col("o_orderdate").cast("date").alias("upload_date"),
        F.floor("o_totalprice").cast("int").alias("duration"),
        F.col("o_orderkey").alias("view_count"),
        F.col("o_orderkey").alias("seq"),
    )
