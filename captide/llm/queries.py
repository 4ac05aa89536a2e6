"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.llm import (
    bpe,
    exact,
    fingerprints,
    language,
    minhash,
    mixing,
    ngrams,
    records,
    repair,
    secret_scan,
    templates,
    toxicity,
    whitening,
)
from captide.llm.common import crc_fold, documents, pages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(documents(spark, sf_dir), width=4)


@query
def op2_byte_bpe(spark, sf_dir):
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode(
        documents(spark, sf_dir), ranks, public_tokenizers.PATTERN, keep=("doc_id",), digests=True
    )


@query
def op4_exact_dedup(spark, sf_dir):
    return exact.exact_duplicates(documents(spark, sf_dir))


@query
def op5_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    fold = crc_fold("doc_id", 4)
    predicted = language.predict(docs, language.learn(docs.where(fold != 2)))
    held_out = F.coalesce(fold == 2, F.lit(False))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages", "shares")


@query
def op6_secret_scan(spark, sf_dir):
    return secret_scan.secret_report(documents(spark, sf_dir))


@query
def op7_source_mix(spark, sf_dir):
    return mixing.mix_report(documents(spark, sf_dir))


@query
def op10_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(documents(spark, sf_dir)).drop("edited_entries")


@query
def op9_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = crc_fold("doc_id", 5)
    model = toxicity.learn(docs, labels.where(fold != 0))
    held_out = F.coalesce(fold == 0, F.lit(False))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op8_lm_score(spark, sf_dir):
    return ngrams.score(documents(spark, sf_dir))


@query
def op3_html_extraction(spark, sf_dir):
    return templates.main_text(pages(spark, sf_dir))


@query
def op11_whitening(spark, sf_dir):
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op12_token_records(spark, sf_dir):
    import public_tokenizers

    tokenizer = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
    return records.token_report(documents(spark, sf_dir), tokenizer)


@query
def op13_conversation_repair(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair.repair(repair.damage(conversations))
