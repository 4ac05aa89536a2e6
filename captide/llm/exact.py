"""Exact duplicates by skew-safe combining, in DataFrame operations only.

Copies are combined three times, each time on the digest and the full text:

1. inside each task, by the map-side half of the first aggregate,
2. per salt, so a text with very many copies is met by several reducers,
3. over the salt winners, of which each text has at most ``SALTS`` and one more.

No task ever holds a group's rows, only one running winner per text.  The rows then get
their group by digest; where two texts share a digest the text decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captide.llm.common import column_place, numbered, stage, text_column

SALTS = 64
# The salt of rows without an id, which are told apart by nothing.
_NO_ID = -1


def text_groups(docs: DataFrame, id_column: str = "doc_id", text_name: str = "text") -> DataFrame:
    """``digest, text, keep_id, group_size, salts`` per distinct text; ``salts`` are those of its rows."""
    doc_id = F.col(id_column).cast("long")
    rows = docs.select(doc_id.alias("doc_id"), text_column(text_name).alias("text")).select(
        "doc_id", "text", F.sha2("text", 256).alias("digest"), _salt(F.col("doc_id"), F.lit(_NO_ID)).alias("salt")
    )
    local = rows.groupBy("digest", "text", "salt").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
    return local.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"), F.collect_set("salt").alias("salts")
    )


def _salt(doc_id: Column, missing: Column) -> Column:
    return F.when(doc_id.isNull(), missing).otherwise(F.pmod(F.xxhash64(doc_id), F.lit(SALTS)))


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_name: str = "text"
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` per row of ``docs``.

    Texts are equal when identical; a null text counts as empty.  The largest id of a
    group stays.  A null id stays only in a group without any other, and then every row
    of the group is marked kept, as are rows that repeat the kept id with the same text.
    Other columns are not read.  An empty table gives an empty result.

    Rows meet their group by digest and salt, and a group goes only to the salts it has
    rows in, so the rows of a text with very many copies are dealt to ``SALTS`` tasks.
    """
    groups = text_groups(docs, id_column, text_name)
    by_digest = stage(
        groups.groupBy("digest").agg(
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
            F.count("*").alias("texts"),
            F.first("salts").alias("salts"),
        ),
        "digests",
    )
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.sha2(text_column(text_name), 256).alias("digest"),
        text_column(text_name).alias("text"),
    )
    columns = ["doc_id", "keep_id", "group_size", "digest"]
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    # Rows without an id may be in any share, so their group goes to all.
    salts = F.when(F.array_contains("salts", _NO_ID), every).otherwise(F.col("salts"))
    alone = by_digest.where("texts = 1").select("digest", F.explode(salts.cast("array<long>")).alias("salt"), "keep_id", "group_size")
    any_share = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    salted = rows.select("doc_id", "digest", _salt(F.col("doc_id"), any_share).cast("long").alias("salt"))
    found = salted.join(alone, ["digest", "salt"]).select(*columns)
    shared = by_digest.where("texts > 1").select("digest")
    if not shared.isEmpty():
        # Only texts whose digest several texts have are moved again.
        compared = rows.join(shared, "digest", "left_semi").join(groups, ["digest", "text"])
        found = found.union(compared.select(*columns))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """One whole row per distinct text of ``documents``, that with the largest id.

    Other columns may have any name.
    """
    plain = numbered(docs)
    doc_id, text = column_place(docs, "doc_id"), column_place(docs, "text")
    kept = exact_duplicates(plain, doc_id, text).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_digest")
    ).distinct()
    digest = F.sha2(text_column(text), 256)
    rows = plain.join(
        kept, F.col(doc_id).eqNullSafe(F.col("kept_id")) & (digest == F.col("kept_digest")), "left_semi"
    )
    # Rows that repeat both the id and the text are one document; the sort of the
    # aggregate is over kept rows only.
    return rows.dropDuplicates([doc_id, text]).toDF(*docs.columns)
