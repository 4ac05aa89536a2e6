"""A training corpus from raw documents: the stages in order, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.llm import bpe, exact, language, minhash, mixing
from captide.llm.common import column_place, crc_fold, documents, numbered, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go.

    Profiles come from the labelled documents outside the held-out fold.
    """
    profiles = language.learn(docs.where(crc_fold("doc_id", 4) != 2))
    rows = numbered(docs)
    texts = rows.withColumn("text", F.col(column_place(docs, "text")))
    predicted = language.predict(texts, profiles, keep=tuple(rows.columns))
    told = predicted.where(F.col("lang_pred") != language.UNKNOWN)
    return told.select(*rows.columns).toDF(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per distinct text."""
    return exact.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words and similarity 0.8."""
    return minhash.without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_rows(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and its text decoded from them."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep=("doc_id", "lang", "source"))


STAGES: list[tuple[str, Stage]] = [
    ("language id", keep_known_languages),
    ("exact dedup", drop_copies),
    ("minhash near-dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("byte bpe", tokenize),
]

# Language inference, similarity links and merges of byte pairs are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
