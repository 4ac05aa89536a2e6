"""Near-duplicate documents by HyperMinHash sketches, banding and exact verification.

A document's set holds the 64-bit hashes of its distinct word shingles.  Its sketch has
``BANDS`` independent hash functions; each deals the set into ``ROWS`` buckets and keeps
per bucket the leading-zero count and the first mantissa bits of the least hash, 16 bits
a register.  An empty bucket borrows from the next one, so short texts have full sketches.

1. One scan sketches every document.  Documents with the same set form one class.
2. Classes whose registers agree in a whole band are candidates.
3. Candidates are compared first with one pivot per band value, then, only where a band
   value still spans several components, across those components.  A pair is verified on
   the two full sets when the collision-corrected estimate leaves any doubt.
4. Verified links give components.

Copies never become pairs: a group of n near copies costs n comparisons with its pivot.
A band value whose members already form one component is never looked at again.

The chance to miss a link of similarity exactly 0.8 is (1 - 0.8**6)**40 = 5e-6, and
falls steeply above; the estimate is used with a margin of six standard deviations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.llm.common import (
    WordHashes,
    column_place,
    lowered_words,
    mix,
    numbered,
    row_slices,
    stage,
    text_column,
)

BANDS = 40
ROWS = 6
MANTISSA_BITS = 8
# Standard deviations below the threshold down to which an estimate is verified.
_MARGIN = 6.0

_REGISTERS = BANDS * ROWS
_CHUNK = 1024
# Classes of one band value compared in one task.
_BLOCK = 2000
_SEED = np.random.default_rng(20240601)
_MULTIPLIERS = _SEED.integers(1, 1 << 32, BANDS, dtype=np.uint32) | np.uint32(1)
_OFFSETS = (np.arange(ROWS, dtype=np.uint64) * (1 << 32) // ROWS).astype(np.uint32)
_BAND_SEEDS = _SEED.integers(1, 1 << 63, BANDS, dtype=np.uint64)
_ROW_SEEDS = _SEED.integers(1, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(words: list[bytes], width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; a shorter text is one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    codes = hashes.of(words)
    n = max(1, len(codes) - width + 1)
    joined = np.zeros(n, np.uint64)
    for k in range(min(width, len(codes))):
        joined = (joined + codes[k : k + n]) * _STEP
    # The length keeps a short text apart from a shingle that begins like it.
    return np.unique(mix(joined + np.uint64(min(width, len(codes)))))


def sketch(members: np.ndarray) -> np.ndarray:
    """Registers of a set, band after band; all ones for an empty set."""
    least = np.full((ROWS, BANDS), 0xFFFFFFFF, np.uint32)
    short = (members >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), _CHUNK):
        h = _MULTIPLIERS[:, None] * short[None, at : at + _CHUNK]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        for row in range(ROWS):
            np.minimum(least[row], (h - _OFFSETS[row]).min(axis=1), out=least[row])
    return compress(least.T).reshape(-1)


def compress(values: np.ndarray) -> np.ndarray:
    """Leading-zero count and mantissa of 32-bit hashes in one 16-bit register."""
    fraction, exponent = np.frexp(values.astype(np.float64))
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA_BITS)).astype(np.int64)
    mantissa = np.where(values == 0, 0, mantissa)
    return ((32 - exponent).astype(np.int64) << MANTISSA_BITS | mantissa).astype(np.uint16)


def collision_rate(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Chance that registers of unrelated sets of these sizes are equal.

    The least of n hashes is close to exponential.  The sum over register values of the
    product of both densities is ab/(a+b) times the cell width, which is a fixed share of
    the value itself, so only the mean relative cell width is left.
    """
    a, b = n_a / ROWS, n_b / ROWS
    return np.minimum(1.0, 0.75 * a * b / (a + b) ** 2 / (1 << MANTISSA_BITS) * 4 / 3)


def estimate(equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, without chance collisions."""
    chance = collision_rate(n_a, n_b)
    return (equal / _REGISTERS - chance) / (1 - chance)


def _sketched(width: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_shingles", pa.int64()),
            ("digest", pa.binary()),
            ("registers", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in batches:
            for batch in row_slices(whole):
                sets = [
                    shingle_set(lowered_words(t), width, hashes)
                    for t in batch.column(1).to_pylist()
                ]
                yield pa.record_batch(
                    [
                        batch.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s) for s in sets], pa.binary()),
                        pa.array([sketch(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    schema=schema,
                )

    return run


def _digest(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def _band_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``cid, registers`` to one row per class and band."""
    for batch in batches:
        registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16)
        registers = registers.reshape(-1, BANDS, ROWS).astype(np.uint64)
        value = mix((registers * _ROW_SEEDS).sum(axis=2, dtype=np.uint64) + _BAND_SEEDS)
        cids = np.repeat(batch.column(0).to_numpy(), BANDS)
        yield pa.record_batch([pa.array(value.reshape(-1).view(np.int64)), pa.array(cids)], ["band", "cid"])


def _doubtful(percent: int):
    """Keep pairs whose estimate does not rule a link out."""
    share = percent / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = share - _MARGIN * np.sqrt(share * (1 - share) / _REGISTERS)
        for batch in batches:
            a, b, n_a, n_b = (batch.column(i).to_numpy() for i in range(4))
            left, right = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, _REGISTERS)
                for i in (4, 5)
            )
            likely = estimate((left == right).sum(axis=1), n_a, n_b) >= floor
            yield pa.record_batch([pa.array(a[likely]), pa.array(b[likely])], ["a", "b"])

    return run


def _linked(width: int, percent: int):
    """Verify pairs on the full sets of both texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, recent = WordHashes(), {}

        def members(cid: int, text: str) -> np.ndarray:
            # A pivot's set serves its whole run of pairs.
            if cid not in recent:
                if len(recent) >= 256:
                    recent.clear()
                recent[cid] = shingle_set(lowered_words(text), width, hashes)
            return recent[cid]

        for whole in batches:
            for batch in row_slices(whole, column=3):
                keep = []
                for a, b, text_a, text_b in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                    left, right = members(a, text_a), members(b, text_b)
                    both = len(np.intersect1d(left, right, assume_unique=True))
                    keep.append(100 * both >= percent * (len(left) + len(right) - both))
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def components(links: DataFrame) -> DataFrame:
    """``cid, component`` of every node on a link; the component is its least node.

    Each round a node takes the least label around it and then its label's label, so
    the rounds grow with the logarithm of the longest path, and labels are written
    between rounds.
    """
    both = stage(
        links.select("a", "b").union(links.select("b", "a")).distinct().toDF("cid", "other"), "links"
    )
    labels = both.groupBy("cid").agg(F.least(F.min("other"), F.col("cid")).alias("component"))
    while True:
        labels = stage(labels, "labels")
        around = both.join(labels.toDF("other", "near"), "other").groupBy("cid").agg(F.min("near").alias("near"))
        hooked = labels.join(around, "cid").select("cid", F.least("component", "near").alias("component"))
        beyond = labels.toDF("component", "beyond")
        jumped = stage(
            hooked.join(beyond, "component", "left").select(
                "cid", F.least("component", F.coalesce("beyond", "component")).alias("new")
            ),
            "jumped",
        )
        moved = jumped.join(labels, "cid").where("new < component").limit(1).count()
        if not moved:
            return labels
        labels = jumped.withColumnRenamed("new", "component")


def _with_sketches(rows: DataFrame, classes: DataFrame, column: str) -> DataFrame:
    side = classes.select("cid", "n_shingles", "registers")
    return rows.join(side.toDF(column, f"n_{column}", f"r_{column}"), column)


def _pivot_links(
    members: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int
) -> DataFrame:
    """Links between each band value's least class and its other classes."""
    pairs = (
        members.where("cid > pivot")
        .select(F.col("pivot").alias("a"), F.col("cid").alias("b"))
        .distinct()
    )
    sketches = _with_sketches(_with_sketches(pairs, classes, "a"), classes, "b")
    # Sizes alone rule a pair out when the smaller set cannot hold enough of the larger.
    fit = sketches.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    doubtful = stage(
        fit.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(_doubtful(percent), "a long, b long"),
        "doubtful",
    )
    with_texts = doubtful.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
    return with_texts.select("a", "b", "text_a", "text_b").mapInArrow(
        _linked(width, percent), "a long, b long"
    )


def _cross_links(
    members: DataFrame,
    labels: DataFrame,
    classes: DataFrame,
    texts: DataFrame,
    width: int,
    percent: int,
) -> DataFrame:
    """Links inside a band value between classes that are in different components so far.

    The pivot has been compared with all, so it is left out.  Members of a value's largest
    component are only looked up; the others ask.  Both are dealt into blocks, and each
    pair of blocks is one group of bounded size.  A block gives links that span what its
    links join, not all of them.
    """
    label = F.coalesce("component", "cid")
    rest = (
        members.where("cid > pivot")
        .join(labels, "cid", "left")
        .select("band", "cid", label.alias("component"))
    )
    by_component = rest.groupBy("band", "component").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("cid").cast("decimal(20,0)")).alias("mark")
    )
    values = (
        by_component.groupBy("band")
        .agg(
            F.max(F.struct("n", "component"))["component"].alias("main"),
            F.sum("n").alias("n"),
            F.count("*").alias("parts"),
            (F.sum("n") - F.max("n")).alias("asking"),
            F.sum("mark").alias("mark"),
        )
        .where("parts > 1")
    )
    # The same members often meet under several bands; one of these is enough.
    values = values.groupBy("n", "parts", "mark", "main").agg(
        F.min("band").alias("band"), F.first("asking").alias("asking")
    )
    blocks = lambda n: F.ceil(F.col(n) / _BLOCK).cast("int")
    rows = rest.join(values, "band").select(
        "band",
        "cid",
        "component",
        (F.col("component") != F.col("main")).alias("asks"),
        blocks("n").alias("n_blocks"),
        blocks("asking").alias("q_blocks"),
    )
    own = lambda of: F.pmod(F.xxhash64("cid"), of).cast("int")
    every = lambda of: F.sequence(F.lit(0), F.col(of) - 1)
    looked_up = rows.select(
        "band",
        own("n_blocks").alias("i"),
        F.explode(every("q_blocks")).alias("q"),
        "cid",
        "component",
        F.lit(False).alias("asks"),
    )
    asking = rows.where("asks").select(
        "band",
        F.explode(every("n_blocks")).alias("i"),
        own("q_blocks").alias("q"),
        "cid",
        "component",
        "asks",
    )
    dealt = (
        looked_up.union(asking)
        .join(classes.select("cid", "n_shingles", "registers"), "cid")
        .join(texts, "cid")
    )
    return (
        dealt.groupBy("band", "i", "q")
        .applyInArrow(_block_links(width, percent), "a long, b long")
        .distinct()
    )


def _block_links(width: int, percent: int):
    def run(block: pa.Table) -> pa.Table:
        asks = block["asks"].to_numpy()
        cid, component = block["cid"].to_numpy(), block["component"].to_numpy()
        size = block["n_shingles"].to_numpy()
        registers = np.frombuffer(b"".join(block["registers"].to_pylist()), np.uint16)
        registers = registers.reshape(-1, _REGISTERS)
        texts, hashes, sets = block["text"], WordHashes(), {}
        share = percent / 100
        floor = share - _MARGIN * np.sqrt(share * (1 - share) / _REGISTERS)

        def members(at: int) -> np.ndarray:
            if cid[at] not in sets:
                sets[cid[at]] = shingle_set(lowered_words(texts[at].as_py()), width, hashes)
            return sets[cid[at]]

        held = np.flatnonzero(~asks)
        # Components merge as links are found: what is joined already is not compared again,
        # and one link is kept for each merge, so a block gives fewer links than it has rows.
        _, merged = np.unique(component, return_inverse=True)
        found = []
        for at in np.flatnonzero(asks):
            other = held[merged[held] != merged[at]]
            small, large = np.minimum(size[other], size[at]), np.maximum(size[other], size[at])
            other = other[100 * small >= percent * large]
            equal = (registers[other] == registers[at]).sum(axis=1)
            other = other[estimate(equal, size[other], size[at]) >= floor]
            if not len(other):
                continue
            many = [members(o) for o in other]
            starts = np.concatenate(([0], np.cumsum([len(m) for m in many])[:-1]))
            mine, pooled = members(at), np.concatenate(many)
            near = np.minimum(np.searchsorted(mine, pooled), len(mine) - 1)
            both = np.add.reduceat((mine[near] == pooled).astype(np.int64), starts)
            linked = other[100 * both >= percent * (size[other] + size[at] - both)]
            joined, first = np.unique(merged[linked], return_index=True)
            found += [(min(cid[at], cid[o]), max(cid[at], cid[o])) for o in linked[first]]
            merged[np.isin(merged, joined)] = merged[at]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _relabelled(rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Rows with a node's component in place of the node."""
    found = rows.join(labels.toDF(column, "__label"), column, "left")
    return found.withColumn(column, F.coalesce("__label", column)).drop("__label").select(*rows.columns)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column_name: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Rows are linked when 100 * shared shingles >= ``percent`` * shingles of both.
    ``component_id`` is the least id reachable over links; ``kept`` marks that row.

    A null or empty text, or one of blanks only, has no shingles: it links with nothing
    and is its own component.  A text of fewer than ``width`` words is one shingle.  Rows
    with a null id take part in links but never name a component that has another id; a
    component of null ids only has a null ``component_id`` and its rows are all kept.
    Rows that repeat an id are linked by their texts like any others.  Other columns,
    whatever their names, are not read.  An empty table gives an empty result.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_column(text_column_name).alias("text"))
    sketched = stage(
        source.mapInArrow(
            _sketched(width), "doc_id long, n_shingles long, digest binary, registers binary"
        ),
        "sketches",
    )
    full = sketched.where("n_shingles > 0")
    # The registers follow from the set, so any of a class's rows will do; the text is
    # fetched by id and checked against the digest when a set is rebuilt.
    classes = stage(
        full.groupBy("digest")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "n_shingles", "registers")).alias("row")
        )
        .select(
            F.monotonically_increasing_id().alias("cid"),
            "digest",
            F.col("row.doc_id").alias("doc_id"),
            F.col("row.n_shingles").alias("n_shingles"),
            F.col("row.registers").alias("registers"),
        ),
        "classes",
    )
    bands = classes.select("cid", "registers").mapInArrow(_band_values, "band long, cid long")
    shared = bands.groupBy("band").agg(F.min("cid").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    members = stage(bands.join(shared, "band").select("band", "cid", "pivot"), "members")
    involved = classes.join(members.select("cid").distinct(), "cid", "left_semi")
    texts = stage(_class_texts(involved, source, width), "texts")

    first = stage(_pivot_links(members, classes, texts, width, percent), "first")
    early = components(first)
    further = _cross_links(members, early, classes, texts, width, percent)
    # Later links join whole components, so only those take part in the second round.
    late = components(_relabelled(_relabelled(further, early, "a"), early, "b").where("a <> b").distinct())
    labelled = _relabelled(_relabelled(classes.select("cid", "digest", "doc_id"), early, "cid"), late, "cid")
    least = labelled.groupBy("cid").agg(F.min("doc_id").alias("component_id"))
    named = labelled.join(least, "cid").select("digest", "component_id")
    linked = full.select("doc_id", "n_shingles", "digest").join(named, "digest")
    empty = sketched.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    return (
        linked.select(*columns)
        .union(empty.select(*columns))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _class_texts(classes: DataFrame, source: DataFrame, width: int) -> DataFrame:
    """``cid, text`` of one text per class; a row with the same id but another set is no match."""
    found = source.join(
        classes.select("cid", "digest", F.col("doc_id").alias("rep")),
        source["doc_id"].eqNullSafe(F.col("rep")),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for whole in batches:
            for batch in row_slices(whole, column=2):
                same = [
                    _digest(shingle_set(lowered_words(t), width, hashes)) == d
                    for d, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
                ]
                yield batch.select([0, 2]).filter(pa.array(same, pa.bool_()))

    checked = found.select("cid", "digest", "text").mapInArrow(run, "cid long, text string")
    return checked.dropDuplicates(["cid"])


def without_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the least id, null last.

    Rows are told apart by a number of their own, so ids may repeat or be null.  A text
    without shingles is a group of its own and stays.  Other columns may have any name.
    """
    plain = numbered(docs)
    doc_id, text = column_place(docs, "doc_id"), column_place(docs, "text")
    rows = stage(plain.withColumn("row", F.monotonically_increasing_id()), "rows")
    texts = rows.select("row", F.col(text).alias("text"))
    found = near_duplicates(texts, id_column="row").select(F.col("doc_id").alias("row"), "component_id")
    order = F.struct(F.col(doc_id).isNull(), doc_id, "row")
    kept = (
        rows.select("row", doc_id)
        .join(found, "row")
        .groupBy("component_id")
        .agg(F.min(order).alias("first"))
        .select(F.col("first.row").alias("row"))
    )
    return rows.join(kept, "row", "left_semi").select(*plain.columns).toDF(*docs.columns)
