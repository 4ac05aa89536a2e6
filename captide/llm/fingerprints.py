"""Document fingerprints as invertible Bloom lookup tables, in DataFrame functions only.

A text's entries are the hashes of its distinct paragraphs with their multiplicities.  A
table has ``CELLS`` cells in three parts; an entry goes to one cell of each part, where a
count, the XOR of the entries and the XOR of their checks are kept.  Two texts' tables
subtract cell by cell, and peeling cells that hold a single entry recovers the entries in
which the texts differ.

When peeling stalls, the entries are dealt to four tables, each peeled by itself, and
those that stall again to four more: a larger table whose work stays linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from captide.llm.common import stage, text_column

PARTS = 3
CELLS = 30
_FAN_OUT = 4
_ROUNDS = 12
_CELL = "struct<n:int,key:bigint,check:bigint>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that is computed once per row."""
    return F.transform(F.array(value), use)[0]


def entries(text: Column) -> Column:
    """Hashes of the distinct paragraphs of a text, each with its multiplicity."""

    def runs(hashes: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(hashes) - 1),
            lambda i: (i == 0) | (F.get(hashes, i) != F.get(hashes, i - 1)),
        )
        return bound(
            starts,
            lambda at: F.transform(
                at,
                lambda i, k: F.xxhash64(F.get(hashes, i), F.coalesce(F.get(at, k + 1), F.size(hashes)) - i),
            ),
        )

    return bound(F.array_sort(F.transform(F.split(text, "\n"), lambda p: F.xxhash64(p))), runs)


def _cell_of(entry: Column, part: Column) -> Column:
    width = CELLS // PARTS
    return part * width + F.pmod(F.xxhash64(entry, part), F.lit(width)).cast("int")


def _part_of(cell: Column) -> Column:
    return F.floor(cell / (CELLS // PARTS)).cast("int")


def _cell(n: Column, key: Column, check: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), key.alias("key"), check.alias("check"))


def _check(entry: Column) -> Column:
    return F.xxhash64(entry)


def sketch(entries: Column) -> Column:
    """The table of a set of entries."""
    empty = _cell(F.lit(0), F.lit(0).cast("long"), F.lit(0).cast("long"))

    def fill(located: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(CELLS - 1)),
            lambda c: F.aggregate(
                F.filter(located, lambda x: F.array_contains(x["cells"], c)),
                empty,
                lambda cell, x: _cell(
                    cell["n"] + 1, cell["key"].bitwiseXOR(x["entry"]), cell["check"].bitwiseXOR(x["check"])
                ),
            ),
        )

    located = F.transform(
        entries,
        lambda e: F.struct(
            e.alias("entry"),
            _check(e).alias("check"),
            F.array(*[_cell_of(e, F.lit(p)) for p in range(PARTS)]).alias("cells"),
        ),
    )
    return bound(located, fill)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(
        a,
        b,
        lambda x, y: _cell(
            x["n"] - y["n"], x["key"].bitwiseXOR(y["key"]), x["check"].bitwiseXOR(y["check"])
        ),
    )


def peel(cells: Column) -> Column:
    """``recovered, complete``: the differing entries found, and whether these are all."""

    def step(state: Column, _: Column) -> Column:
        single = F.filter(
            state["cells"], lambda c: (F.abs(c["n"]) == 1) & (_check(c["key"]) == c["check"])
        )
        # An entry may be alone in several of its cells.
        pure = F.array_distinct(F.transform(single, lambda c: F.struct(c["key"].alias("key"), c["n"].alias("n"))))

        def take_out(pure: Column) -> Column:
            located = F.transform(
                pure,
                lambda p: F.struct(
                    p["key"].alias("key"),
                    p["n"].alias("n"),
                    F.array(*[_cell_of(p["key"], F.lit(k)) for k in range(PARTS)]).alias("cells"),
                ),
            )
            rest = bound(
                located,
                lambda where: F.transform(
                    state["cells"],
                    lambda c, i: F.aggregate(
                        F.filter(where, lambda p: F.array_contains(p["cells"], i)),
                        c,
                        lambda acc, p: _cell(
                            acc["n"] - p["n"],
                            acc["key"].bitwiseXOR(p["key"]),
                            acc["check"].bitwiseXOR(_check(p["key"])),
                        ),
                    ),
                ),
            )
            found = F.concat(state["recovered"], F.transform(pure, lambda p: p["key"]))
            return F.when(
                F.size(pure) > 0, F.struct(rest.alias("cells"), found.alias("recovered"))
            ).otherwise(state)

        return bound(pure, take_out)

    start = F.struct(
        cells.cast(f"array<{_CELL}>").alias("cells"), F.array().cast("array<bigint>").alias("recovered")
    )
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(_ROUNDS)),
        start,
        step,
        lambda state: F.struct(
            state["recovered"].alias("recovered"),
            F.forall(
                state["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0)
            ).alias("complete"),
        ),
    )


def written(cells: Column) -> Column:
    """A table as text: its filled cells as ``place:count:key:check``."""
    parts = F.transform(
        cells,
        lambda c, i: F.when(
            c["n"] != 0,
            F.concat_ws(":", i.cast("string"), c["n"].cast("string"), F.hex(c["key"]), F.hex(c["check"])),
        ),
    )
    return F.array_join(parts, ",")


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next_text``: each document with the text of the next in descending id order.

    After the last comes the first; a single document is its own next.  Null ids come
    last; documents with one id are ordered by text.  Documents are dealt to id ranges of
    equal counts, ordered inside their range, and the last of a range looks at the first of
    the next range, so no task sees more than its range.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [k / ranges for k in range(1, ranges)]
    cuts = rows.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, steps or [0.5])), 100 * ranges)).first()[0]
    edges = F.array(*[F.lit(c).cast("long") for c in sorted(set(cuts or [0]))])
    # Ranges count upward as ids fall; rows without an id come last.
    place = F.coalesce(
        F.size(F.filter(edges, lambda c: F.col("doc_id") < c)), F.lit(-1)
    )
    place = F.when(F.col("doc_id").isNull(), F.lit(ranges + 1)).otherwise(place)
    ranged = rows.withColumn("range", place)
    order = [F.col("doc_id").desc_nulls_last(), F.col("text").desc()]
    heads = ranged.groupBy("range").agg(
        F.max_by("text", F.struct(F.col("doc_id"), F.col("text"))).alias("head")
    )
    # One row per range in this window.
    by_range = W.orderBy("range")
    everywhere = W.orderBy("range").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    following = heads.select(
        "range",
        F.coalesce(F.lead("head").over(by_range), F.first("head").over(everywhere)).alias("beyond"),
    )
    inside = ranged.withColumn("inner", F.lead("text").over(W.partitionBy("range").orderBy(*order)))
    return inside.join(following, "range").select(
        "doc_id", "text", F.coalesce("inner", "beyond").alias("next_text")
    )


def compare(pairs: DataFrame, key: list[str]) -> DataFrame:
    """``key, differing, recovered`` from ``key, left, right`` entry arrays, by larger tables.

    Every pass deals a pair's entries to ``_FAN_OUT`` tables; a table that peels settles
    its entries, the others are dealt on.  Each pass is written, so passes do not pile up
    in one plan.
    """
    settled, level = None, 0
    pending = pairs.select(*key, F.lit("").alias("path"), "left", "right")
    while True:
        level += 1
        sides = [
            pending.select(*key, "path", F.explode(side).alias("entry"), F.lit(at).alias("side"))
            for at, side in enumerate(("left", "right"))
        ]
        own = F.pmod(F.xxhash64("entry", F.lit(level)), F.lit(_FAN_OUT)).cast("string")
        tables = (
            sides[0]
            .union(sides[1])
            .withColumn("path", F.concat("path", own))
            .groupBy(*key, "path")
            .agg(
                F.collect_list(F.when(F.col("side") == 0, F.col("entry"))).alias("left"),
                F.collect_list(F.when(F.col("side") == 1, F.col("entry"))).alias("right"),
            )
        )
        tried = stage(
            tables.withColumn("peeled", peel(subtract(sketch(F.col("left")), sketch(F.col("right"))))),
            "peeled",
        )
        done = tried.where("peeled.complete").select(*key, F.col("peeled.recovered").alias("recovered"))
        settled = done if settled is None else settled.union(done)
        pending = tried.where("NOT peeled.complete").select(*key, "path", "left", "right")
        if pending.isEmpty():
            return settled.groupBy(*key).agg(F.flatten(F.collect_list("recovered")).alias("recovered"))


def likeness(n_left: Column, n_right: Column, differing: Column) -> Column:
    """Shared share of all entries of both sides, from the number in which they differ."""
    return (n_left + n_right - differing) / (n_left + n_right + differing)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The last third of a text's code points is replaced by as many (or all) of the next
    document's.  Returns ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next`` and the recovered differing entries.

    A null text counts as empty, and an empty text is one empty paragraph.  Rows that
    repeat an id are documents of their own.  Equal texts have equal fingerprints and
    likeness 1.  Other columns are not read; an empty table gives an empty result.
    """
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    texts = with_next(docs).select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(edited, 256).alias("edited_sha256"),
        entries(F.col("text")).alias("own"),
        entries(edited).alias("edited"),
        entries(F.col("next_text")).alias("next"),
    )
    tables = texts.select(
        "*", *[sketch(F.col(c)).alias(f"{c}_cells") for c in ("own", "edited", "next")]
    )
    peeled = tables.select(
        "*",
        peel(subtract(F.col("own_cells"), F.col("edited_cells"))).alias("from_edited"),
        peel(subtract(F.col("own_cells"), F.col("next_cells"))).alias("from_next"),
    )

    def stalled(kind: str, side: str) -> Column:
        pair = F.struct(F.lit(kind).alias("kind"), F.col("own").alias("left"), F.col(side).alias("right"))
        return F.when(~F.col(f"from_{kind}.complete"), pair)

    first = stage(
        peeled.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "n_chars",
            "edited_sha256",
            written(F.col("own_cells")).alias("fingerprint"),
            written(F.col("edited_cells")).alias("edited_fingerprint"),
            *[F.size(c).alias(f"n_{c}") for c in ("own", "edited", "next")],
            "from_edited",
            "from_next",
            F.filter(
                F.array(stalled("edited", "edited"), stalled("next", "next")), lambda p: p.isNotNull()
            ).alias("stalled"),
        ),
        "tables",
    )
    again = first.select("row", F.inline("stalled"))
    larger = (
        compare(again, ["row", "kind"])
        .groupBy("row")
        .agg(
            *[
                F.max(F.when(F.col("kind") == k, F.col("recovered"))).alias(f"{k}_again")
                for k in ("edited", "next")
            ]
        )
    )
    whole = first.join(larger, "row", "left")

    def differing(kind: str) -> Column:
        return F.when(F.col(f"from_{kind}.complete"), F.col(f"from_{kind}.recovered")).otherwise(
            F.coalesce(f"{kind}_again", F.array().cast("array<bigint>"))
        )

    return whole.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("n_own"), F.col("n_edited"), F.size(differing("edited"))).alias("near_edited"),
        likeness(F.col("n_own"), F.col("n_next"), F.size(differing("next"))).alias("near_next"),
        differing("edited").alias("edited_entries"),
    )
