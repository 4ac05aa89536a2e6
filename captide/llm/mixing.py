"""Mix sources to target weights by fitting a subset sum to each source's budget.

Targets come from water-filling over the sources: a share by weight, at most twice the
source's size.  A source gives every document once while its budget lasts for a whole
pass; what remains is a bounded knapsack over its document lengths: how many documents of
each exact length to take once more so that the words come as close as possible.

Documents are counted by (source, length), so the knapsack never sees a document.  Within
one length the documents are chosen by a seeded hash of the row.  Rows of one length are
spread over ``_SPLIT`` hash ranges; only one range of a length is ever ordered, the others
are taken or left whole, so a length held by a third of all rows makes no hot task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from captide.llm.common import BLANKS, column_place, numbered, stage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE_PERCENT = 150
MOST_TIMES = 2
SEED = 17
# Hash ranges of one length at least, and documents per range of a large table.
_LEAST_RANGES, _RANGE_ROWS = 64, 50_000
# Words left to the exact search once whole lengths have been taken in proportion.
_REACH = 1 << 16


def words_of(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{BLANKS}]+")), F.lit(0)).cast("long")


def _source_key(column: Column) -> Column:
    """A key without nulls that orders like the source, a null one last."""
    return F.when(column.isNull(), "~").otherwise(F.concat(F.lit("!"), column))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, percent: int = SHARE_PERCENT) -> DataFrame:
    """``source_key, source_size, target`` from ``source_key, size, n`` counts.

    One row per source: the windows below order sources, never documents.  With sources
    in order of size per weight, those below some point get twice their size and the
    others share the rest by weight; the point is the first at which the next source
    would not be cut.
    """
    totals = sizes.groupBy("source_key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    rank = F.row_number().over(W.orderBy("source_key")) - 1
    weighed = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(rank, F.lit(len(weights))) + 1))
    cap = F.col("source_size") * MOST_TIMES
    by_level = W.orderBy(cap / F.col("weight"), "source_key").rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = weighed.select(
        "*",
        F.row_number().over(W.orderBy(cap / F.col("weight"), "source_key")).alias("rank"),
        (F.sum("source_size").over(every) * (percent / 100)).alias("budget"),
        F.coalesce(F.sum(cap).over(by_level), F.lit(0)).alias("capped"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0))).alias("open"),
    ).withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open"))
    fits = F.col("level") * F.col("weight") <= cap
    first = F.min(F.when(fits, F.struct("rank", "level"))).over(every)
    return levels.withColumn("share", first["level"]).select(
        "source_key",
        "source_size",
        F.coalesce(F.least(cap.cast("double"), F.col("share") * F.col("weight")), cap.cast("double")).alias("target"),
    )


def fit_lengths(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to a budget.

    What exceeds the reach of the exact search is taken in proportion from all lengths, so
    a budget within it is met as closely as any choice can.  The rest is a bounded knapsack: sums that some choice reaches are bits of one integer, items are powers of
    two of a length's remaining documents, and the choice is read back item by item.
    """
    total = int((sizes * counts).sum())
    if budget >= total:
        return counts.copy()
    taken = counts * max(0, budget - _REACH) // max(1, total)
    left = max(0, budget) - int((sizes * taken).sum())
    # Whole documents, longest first, until the rest is within reach of the exact search.
    for k in np.argsort(-sizes, kind="stable").tolist():
        if left <= _REACH:
            break
        more = min(int(counts[k] - taken[k]), (left - _REACH // 2) // int(sizes[k])) if sizes[k] else 0
        taken[k] += max(0, more)
        left -= max(0, more) * int(sizes[k])
    spare = counts - taken
    limit = left + int(sizes.max(initial=0))
    mask = (1 << limit + 1) - 1
    items, reach = [], 1
    for k in np.flatnonzero((spare > 0) & (sizes > 0)).tolist():
        n, part = int(min(spare[k], limit // sizes[k])), 1
        while n > 0:
            use = min(part, n)
            items.append((k, use))
            reach = (reach | reach << use * int(sizes[k])) & mask
            n, part = n - use, part * 2
        if reach >> left & 1:
            break
    below = (reach & (1 << left + 1) - 1).bit_length() - 1
    over = reach >> left + 1
    above = left + 1 + ((over & -over).bit_length() - 1) if over else None
    at = above if above is not None and above - left < left - below else below
    for (k, use), before in _backwards(items, sizes, mask):
        if not before >> at & 1:
            at -= use * int(sizes[k])
            taken[k] += use
    return taken


def _backwards(
    items: list[tuple[int, int]], sizes: np.ndarray, mask: int
) -> Iterator[tuple[tuple[int, int], int]]:
    """Items from the last to the first, each with the sums reached before it.

    The sums are kept at every few items and built again between them, so no more than
    about twice the square root of their number is held at a time.
    """

    def after(reach: int, item: tuple[int, int]) -> int:
        return (reach | reach << item[1] * int(sizes[item[0]])) & mask

    step = max(1, math.isqrt(len(items)))
    kept, reach = [], 1
    for at, item in enumerate(items):
        if at % step == 0:
            kept.append(reach)
        reach = after(reach, item)
    for block in range(len(kept) - 1, -1, -1):
        part, reach, states = items[block * step : (block + 1) * step], kept[block], []
        for item in part:
            states.append(reach)
            reach = after(reach, item)
        yield from zip(reversed(part), reversed(states), strict=True)


def _choose(lengths: pd.DataFrame) -> pd.DataFrame:
    """One source's lengths with whole passes and the number of documents to take once more."""
    lengths = lengths.sort_values("size", kind="stable")
    size, n = lengths["size"].to_numpy(), lengths["n"].to_numpy()
    target, total = round(float(lengths["target"].iloc[0])), int(lengths["source_size"].iloc[0])
    passes = min(MOST_TIMES, target // total) if total else 1
    more = fit_lengths(size, n, target - passes * total) if passes < MOST_TIMES and total else n * 0
    return pd.DataFrame(
        {"source_key": lengths["source_key"], "size": size, "passes": passes, "more": more, "source_size": total}
    ).assign(target=lengths["target"])


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """All rows of ``docs``, columns ``c0`` on, and ``size, source_size, target, times``.

    ``times`` says how often the mix takes a document: 0, 1 or 2.  A null text has size
    0; a null source is one of its own, last in order.  Documents without words are taken
    once, as they cost nothing; so are all of a source without words.  Choices depend only
    on the row's values and the seed, so reruns agree; rows equal in id and text are told
    apart by nothing and share their hash, and which of them is taken is arbitrary.  An
    empty table gives an empty result.  Columns are named by place, so extra ones may have
    any name.

    Documents of one source and length are dealt to hash ranges, more of them the larger
    the table is, so that one range of the commonest length is a bounded part of it.
    """
    return _mixed(_sized(docs, seed), [f"c{i}" for i in range(len(docs.columns))])


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """Numbered rows with their source's key, size, seeded order and hash range."""
    doc_id, text, source = (F.col(column_place(docs, c)) for c in ("doc_id", "text", "source"))
    ranges = max(_LEAST_RANGES, docs.count() // _RANGE_ROWS)
    order = F.xxhash64(F.lit(seed), doc_id, text)
    return numbered(docs).withColumns(
        {"key": _source_key(source), "size": words_of(text), "order": order, "range": F.pmod(order, F.lit(ranges))}
    )


def _mixed(rows: DataFrame, keep: list[str]) -> DataFrame:
    counts = stage(
        rows.groupBy(F.col("key").alias("source_key"), "size", "range").agg(F.count("*").alias("n")), "lengths"
    )
    lengths = counts.groupBy("source_key", "size").agg(F.sum("n").alias("n"))
    targets = source_targets(lengths)
    chosen = (
        lengths.join(targets, "source_key")
        .groupBy("source_key")
        .applyInPandas(
            _choose,
            "source_key string, size long, passes int, more long, source_size long, target double",
        )
    )
    before = F.coalesce(
        F.sum("n").over(
            W.partitionBy("source_key", "size").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    # Per hash range: all of it, none of it, or the first ``rest`` of it once more.
    taken = (
        counts.join(chosen, ["source_key", "size"])
        .withColumn("rest", F.greatest(F.lit(0), F.least("n", F.col("more") - before)))
        .select(F.col("source_key").alias("key"), "size", "range", "passes", "rest", "n", "source_size", "target")
    )
    joined = rows.join(stage(taken, "ranges"), ["key", "size", "range"])
    whole = joined.where("rest = 0 OR rest = n").withColumn("once_more", F.col("rest") > 0)
    place = F.row_number().over(W.partitionBy("key", "size", "range").orderBy("order"))
    partly = joined.where("rest > 0 AND rest < n").withColumn("once_more", place <= F.col("rest"))
    return whole.unionByName(partly).select(
        *keep,
        "size",
        "source_size",
        "target",
        F.when(F.col("size") == 0, 1)
        .otherwise(F.col("passes") + F.col("once_more").cast("int"))
        .alias("times"),
    )


def mix_report(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` per document; texts are read once, for their sizes."""
    rows = _sized(docs.select("doc_id", "text", "source"), seed)
    return _mixed(stage(rows.drop("c1"), "sizes"), ["c0"]).select(
        F.col("c0").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("times")).alias("taken"),
    )


def mixed_rows(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` as often as the mix takes it."""
    rows = mix(docs).where("times > 0")
    copies = F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("copy")
    return rows.select(*rows.columns[: len(docs.columns)], copies).drop("copy").toDF(*docs.columns)
