"""Language-model scores by a weighted backoff automaton over word n-grams.

Every n-gram of up to ``ORDER`` words of every training text is counted, whatever its
frequency, so the model grows with the corpus and is never gathered: counts meet the texts
in exchanges.

A task packs some documents at a time: their words once each, as hashes, and the texts as
places in that list.  Packs are written.  Each pack sends its distinct n-grams, as hashes
dealt into buckets, and gets back their corpus counts; a last exchange adds up how many
different words follow each context.  From these a task builds its pack's own part of the
automaton, and each text is traversed once.  No n-gram meets more rows than there are packs.

What is exchanged is a multiple of the input, so it goes in rounds, words and pairs first and
triples next; the shuffle files of a round are dropped once its sums are written.  Hashes go
sorted, as differences, and their high bytes, counts and sums compressed.

Probabilities are absolute-discounted and interpolated: a counted n-gram is an arc; otherwise
the failure arc's weight is added and the shorter context asked, down to the root, which
holds every word, known or not.  An n-gram is told by 62 bits of a hash and its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.llm.common import crc_fold, lowered_words, mix, row_slices, stage, text_column
from captide.sources.staging import dropped_shuffles

ORDER = 3
SMOOTHING = 0.1
DISCOUNT = 0.75
# The end of a text, which no word can be as it holds a blank.
END = b" end"
# Buckets of an exchange: at least so many, and one more for each so many tokens.
_BUCKETS, _BUCKET_TOKENS = 512, 1 << 18
# Text of a pack; bounds a task's memory.
_PACK_BYTES = 5 << 20
# n-grams added up together inside a task.
_KEYS_AT_ONCE = 400_000

_PACK = "pack long, docs array<long>, held_out array<boolean>, lengths array<int>, codes binary, words binary, distinct long, tokens long, taught long"
_ASKED = "bucket long, pack long, size int, asked binary"
_TOLD = "bucket long, pack long, size int, told binary, words long"
# Rounds of the exchange: words and pairs, triples, followers of contexts.
_SHORT, _LONG, _FOLLOWERS = range(3)
# Bytes of a difference of sorted hashes that are as good as random, the low ones.
_RANDOM_BYTES = 5


def _planes(values: np.ndarray) -> np.ndarray:
    """A row for each byte of the numbers, the lowest first: high ones are alike and compress."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T


def _numbers(planes: np.ndarray, kind: type) -> np.ndarray:
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _shrunk(planes: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(planes), "zstd", asbytes=True)


def _grown(shrunk: bytes, planes: int, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(shrunk, planes * n, "zstd"), np.uint8).reshape(planes, n)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, text, held_out`` to packs; codes go by descending frequency in the pack."""
    part, serial = TaskContext.get().partitionId(), 0
    for whole in batches:
        for batch in row_slices(whole, most=_PACK_BYTES):
            texts = [lowered_words(t) + [END] for t in batch.column(1).to_pylist()]
            lengths = np.array([len(t) for t in texts], np.int32)
            tokens = pa.array([w for t in texts for w in t], pa.large_binary()).dictionary_encode()
            hashes = [xxhash.xxh3_64_intdigest(w) for w in tokens.dictionary.to_pylist()]
            words, codes = np.unique(np.array(hashes, np.uint64), return_inverse=True)
            codes = codes[tokens.indices.to_numpy()]
            order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            codes = place[codes]
            held = batch.column(2).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 24) + serial], pa.int64()),
                    pa.array([batch.column(0)], pa.list_(pa.int64())),
                    pa.array([held], pa.list_(pa.bool_())),
                    pa.array([lengths], pa.list_(pa.int32())),
                    pa.array([_shrunk(_planes(codes))], pa.binary()),
                    # Words of the same frequency are in order, so their differences are short.
                    pa.array([_shrunk(_planes(np.diff(words[order], prepend=np.uint64(0))))], pa.binary()),
                    pa.array([len(words)], pa.int64()),
                    pa.array([lengths.sum()], pa.int64()),
                    pa.array([lengths[~held].sum()], pa.int64()),
                ],
                ["pack", "docs", "held_out", "lengths", "codes", "words", "distinct", "tokens", "taught"],
            )
            serial += 1


def _joined(parts: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, kind)


class Pack:
    """Texts of a pack as places in its lists of distinct words, pairs and triples.

    The list of n-grams of more than ``longest`` words is empty.
    """

    def __init__(self, row: dict, longest: int = ORDER):
        self.lengths = np.array(row["lengths"], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.codes = _numbers(_grown(row["codes"], 4, row["tokens"]), np.int32)
        self.words = np.cumsum(_numbers(_grown(row["words"], 8, row["distinct"]), np.uint64), dtype=np.uint64)
        self.teaches = np.repeat(~np.array(row["held_out"], bool), self.lengths)
        # Of each token, how many of its text stand before it.
        place = np.arange(len(self.codes), dtype=np.int32) - np.repeat(self.starts.astype(np.int32), self.lengths)
        n_words = len(self.words)
        # Of each token, the place of the pair and the triple that end in it, or -1.
        self.pairs, self.pair = self._ending(self.codes, np.flatnonzero(place >= 1))
        self.triples, self.triple = self._ending(self.pair, np.flatnonzero((place >= 2) & (longest > 2)))
        self.sizes = np.cumsum([n_words, len(self.pairs)])

    def _ending(self, before: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct numbers of what stands before tokens and the tokens, and each one's place."""
        found, inverse = np.unique(before[at - 1].astype(np.int64) * len(self.words) + self.codes[at], return_inverse=True)
        place = np.full(len(self.codes), -1, np.int32)
        place[at] = inverse
        return found, place

    def contexts(self) -> np.ndarray:
        """The word before each pair and the place, after all words, of the pair before each triple."""
        n_words = len(self.words)
        return np.concatenate((self.pairs // n_words, n_words + self.triples // n_words))

    def keys(self) -> np.ndarray:
        """A hash of each word, pair and triple, with its length in the lowest bits."""
        n_words, few, step = len(self.words), ~np.uint64(3), np.uint64(0x9E3779B97F4A7C15)
        first, last = np.divmod(self.pairs, n_words)
        pairs = mix(mix(self.words)[first] * step + self.words[last])
        first, last = np.divmod(self.triples, n_words)
        triples = mix(mix(pairs)[first] * step + self.words[last])
        return np.concatenate([k & few | np.uint64(n) for n, k in enumerate((self.words, pairs, triples), 1)])

    def taught(self) -> np.ndarray:
        """How often each is in training texts."""
        return np.concatenate(
            [
                np.bincount(at[self.teaches & (at >= 0)], minlength=n)
                for at, n in ((self.codes, len(self.words)), (self.pair, len(self.pairs)), (self.triple, len(self.triples)))
            ]
        )


def _asked(pack: int, keys: np.ndarray, n: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Sorted keys of a pack and their numbers, a row for each bucket."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    steps = np.diff(keys, prepend=np.uint64(0))
    steps[cuts] = keys[cuts]
    low, high = np.split(np.ascontiguousarray(_planes(steps)), [_RANDOM_BYTES])
    high = np.concatenate((high, _planes(n.astype(np.int32))))
    ends = np.append(cuts, len(keys))[1:].tolist()
    rows = [low[:, a:b].tobytes() + _shrunk(high[:, a:b]) for a, b in zip(cuts.tolist(), ends, strict=True)]
    yield pa.record_batch(
        [
            pa.array(bucket[cuts], pa.int64()),
            pa.array(np.full(len(cuts), pack), pa.int64()),
            pa.array(np.diff(cuts, append=len(keys)), pa.int32()),
            pa.array(rows, pa.binary()),
        ],
        ["bucket", "pack", "size", "asked"],
    )


def _read_asked(asked: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a row and their numbers."""
    cut = _RANDOM_BYTES * size
    low, high = np.frombuffer(asked[:cut], np.uint8), _grown(asked[cut:], 12 - _RANDOM_BYTES, size)
    planes = np.concatenate((low.reshape(_RANDOM_BYTES, size), high))
    return np.cumsum(_numbers(planes[:8], np.uint64), dtype=np.uint64), _numbers(planes[8:], np.int32)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows asked, by bucket, to each key's sum, and marks of the row that speaks for the key."""

    def told(rows: list[tuple]) -> pa.RecordBatch:
        parts, numbers = zip(*[r[2] for r in rows], strict=True)
        keys, first, inverse = np.unique(np.concatenate(parts), return_index=True, return_inverse=True)
        n = np.concatenate(numbers)
        sums = np.bincount(inverse, n, len(keys)).astype(np.int64)
        speaks = np.zeros(len(n), bool)
        speaks[first[sums > 0]] = True
        words = speaks & (keys & np.uint64(3) == 1)[inverse]
        ends = np.cumsum([len(p) for p in parts])
        cuts = list(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True))
        # The mark stands in the lowest bit.
        planes = np.ascontiguousarray(_planes(sums[inverse] << 1 | speaks))
        return pa.record_batch(
            [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([len(p) for p in parts], pa.int32()),
                pa.array([_shrunk(planes[:, a:b]) for a, b in cuts], pa.binary()),
                pa.array([int(words[a:b].sum()) for a, b in cuts], pa.int64()),
            ],
            ["bucket", "pack", "size", "told", "words"],
        )

    rows, held = [], 0
    for batch in batches:
        for row in zip(*batch.columns, strict=True):
            bucket, pack, size, asked = (v.as_py() for v in row)
            if held >= _KEYS_AT_ONCE and bucket != rows[-1][0]:
                yield told(rows)
                rows, held = [], 0
            rows.append((bucket, pack, _read_asked(asked, size)))
            held += size
    if rows:
        yield told(rows)


def _exchanged(asked: DataFrame) -> DataFrame:
    """Sums of keys over all packs, per bucket and pack in the order asked."""
    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_added, _TOLD)


def _counted(buckets: int, step: int):
    """Packs to their distinct n-grams of a round and how often each is in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                pack = Pack(row, ORDER if step == _LONG else ORDER - 1)
                skipped = pack.sizes[1] if step == _LONG else 0
                keys, n = pack.keys()[skipped:], pack.taught()[skipped:]
                order = np.argsort(keys)
                yield from _asked(row["pack"], keys[order], n[order], buckets)

    return run


def _told(told: pa.Table, step: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key's sum in a round, and whether this pack speaks for it."""
    rows = told.filter(pc.equal(told["step"], step)).sort_by("bucket")
    each = zip(rows["told"].to_pylist(), rows["size"].to_pylist(), strict=True)
    parts = [_numbers(_grown(told, 8, size), np.int64) for told, size in each]
    order = np.argsort(keys)
    found = np.empty(len(keys), np.int64)
    found[order] = _joined(parts, np.int64)
    return found >> 1, found & 1 > 0


def _told_counts(told: pa.Table, pack: Pack, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each n-gram's count, and whether this pack speaks for it."""
    cut = pack.sizes[1]
    rounds = _told(told, _SHORT, keys[:cut]), _told(told, _LONG, keys[cut:])
    counts, firsts = (np.concatenate(parts) for parts in zip(*rounds, strict=True))
    return counts, firsts


def _open(counts: np.ndarray, n_contexts: int) -> np.ndarray:
    """Contexts whose followers are to be counted; one seen once has one."""
    return np.flatnonzero(counts[:n_contexts] > 1)


def _followed(buckets: int):
    """A pack and its counts to its contexts and how many followers it speaks for."""

    def run(pack: pa.Table, told: pa.Table) -> pa.Table:
        batches = []
        for row in pack.to_pylist():
            texts = Pack(row)
            keys = texts.keys()
            counts, firsts = _told_counts(told, texts, keys)
            spoken = np.bincount(texts.contexts()[firsts[texts.sizes[0] :]], minlength=texts.sizes[1])
            asked = _open(counts, texts.sizes[1])
            asked = asked[np.argsort(keys[asked])]
            batches += _asked(row["pack"], keys[asked], spoken[asked], buckets)
        return pa.Table.from_batches(batches)

    return run


class Automaton:
    """States are the root, the words and the pairs; arcs are pairs and triples.

    A word's number is 1 or more; 0 stands for no word and for the root.
    """

    def __init__(self, word_counts: np.ndarray, total: int, distinct: int, grams: dict[int, dict[int, int]]):
        """``word_counts`` by word; ``grams`` by length, with numbers in base ``words + 1`` as keys."""
        base = len(word_counts) + 1
        pairs, triples = (np.array(sorted(grams.get(n, {})), np.int64) for n in (2, 3))
        before = self._places(pairs, triples // base)
        before, triples = before[before >= 0], triples[before >= 0]
        self._lay(
            word_counts,
            total,
            distinct,
            (pairs, np.array([grams[2][g] for g in pairs.tolist()], np.int64)),
            (before * base + triples % base, np.array([grams[3][g] for g in triples.tolist()], np.int64)),
        )

    @classmethod
    def of_pack(cls, pack: Pack, counts: np.ndarray, followers: np.ndarray, total: int, distinct: int) -> Automaton:
        """The part of the corpus automaton a pack meets; ``followers`` by word, then pair."""
        model, n_words = cls.__new__(cls), len(pack.words)
        words, pairs, triples = np.split(counts, pack.sizes)
        first, last = np.divmod(pack.pairs, n_words)
        before, word = np.divmod(pack.triples, n_words)
        model._lay(
            words,
            total,
            distinct,
            ((first + 1) * (n_words + 1) + last + 1, pairs),
            (before * (n_words + 1) + word + 1, triples),
            np.split(followers, pack.sizes[:1]),
        )
        return model

    def _lay(self, word_counts, total, distinct, pairs, triples, followers=None) -> None:
        """Arcs and failure weights; a triple's number is its pair's place times base and its word."""
        self.total, self.distinct, self.base = total, distinct, len(word_counts) + 1
        (self.pairs, pair_counts), (self.triples, triple_counts) = pairs, triples
        self.own, self.left = [], []
        levels = (
            (np.concatenate(([0], word_counts)), self.pairs // self.base, pair_counts),
            (pair_counts, self.triples // self.base, triple_counts),
        )
        for level, (counts, context, c) in enumerate(levels):
            own = np.where(c > 0, (c - DISCOUNT) / np.maximum(counts[context], 1), 0.0)
            if followers is None:
                left = np.maximum(1e-12, 1 - np.bincount(context, own, len(counts)))
                left[np.bincount(context[c > 0], minlength=len(counts)) == 0] = 1.0
            else:
                n = followers[level] if level else np.concatenate(([0], followers[level]))
                left = np.where(n > 0, DISCOUNT * n / np.maximum(counts, 1), 1.0)
            # The last one is that of no arc and no state.
            self.own.append(np.append(own, 0.0))
            self.left.append(np.append(left, 1.0))

    @staticmethod
    def _places(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Places of values in a sorted array, or -1."""
        if not len(sorted_values):
            return np.full(len(values), -1)
        at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
        return np.where(sorted_values[at] == values, at, -1)

    def root(self, counts: np.ndarray) -> np.ndarray:
        """Log-probabilities of words by their training counts."""
        return np.log10((counts + SMOOTHING) / (self.total + SMOOTHING * (self.distinct + 1)))

    def steps(self, root: np.ndarray, before: np.ndarray, pair: np.ndarray, triple: np.ndarray, state: np.ndarray) -> np.ndarray:
        """Log-probability of each token: its arc, or the failure arcs to a state that has one.

        ``before`` is the number of the word before, ``pair`` and ``triple`` the places of
        the arcs, and ``state`` that of the pair before, each -1 if there is none.
        """
        shorter = self.own[0][pair] + self.left[0][before] * 10**root
        return np.log10(self.own[1][triple] + self.left[1][state] * shorter)

    def traverse(self, numbers: list[int], root: list[float]) -> float:
        """Log-probability of one text from its words' numbers (0: none) and root values."""
        word = np.array(numbers, np.int64)
        before = np.concatenate(([0], word))[: len(word)]
        pair = np.where((word > 0) & (before > 0), self._places(self.pairs, before * self.base + word), -1)
        state = np.concatenate(([-1], pair))[: len(word)]
        triple = np.where((word > 0) & (state >= 0), self._places(self.triples, state * self.base + word), -1)
        return float(self.steps(np.array(root, float), before, pair, triple, state).sum())


def _scored(total: int, distinct: int):
    def run(pack: pa.Table, told: pa.Table) -> pa.Table:
        tables = []
        for row in pack.to_pylist():
            texts = Pack(row)
            keys = texts.keys()
            counts, _ = _told_counts(told, texts, keys)
            followers = counts[: texts.sizes[1]].clip(0, 1)
            asked = _open(counts, texts.sizes[1])
            followers[asked], _ = _told(told, _FOLLOWERS, keys[asked])
            automaton = Automaton.of_pack(texts, counts, followers, total, distinct)
            known = counts[texts.codes]
            root = automaton.root(known)
            before, state = np.append(0, texts.codes[:-1] + 1), np.append(-1, texts.pair[:-1])
            before[texts.starts], state[texts.starts] = 0, -1
            steps = automaton.steps(root, before, texts.pair, texts.triple, state)
            tables.append(
                pa.table(
                    {
                        "doc_id": pa.array(row["docs"], pa.int64()),
                        "held_out": pa.array(row["held_out"], pa.bool_()),
                        "n_tokens": texts.lengths,
                        "n_known": np.add.reduceat((known > 0).astype(np.int64), texts.starts),
                        "train_tokens": np.full(len(texts.lengths), total),
                        "base_score": np.add.reduceat(root, texts.starts),
                        "score": np.add.reduceat(steps, texts.starts),
                    }
                )
            )
        return pa.concat_tables(tables)

    return run


def score(docs: DataFrame, folds: int = 10, held_out_fold: int = 0) -> DataFrame:
    """Scores of every whole text under a model of those outside the held-out fold.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.  A null
    or empty text is its end only.  Rows with a null id are scored but teach nothing.
    Repeated rows count as often as they occur.  Only ``doc_id`` and ``text`` are read; an
    empty table gives an empty result.
    """
    fold = crc_fold("doc_id", folds)
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_column().alias("text"),
        # Neither fold for a null id: it is not held out, and it teaches nothing either.
        F.coalesce(fold == held_out_fold, F.lit(True)).alias("apart"),
    )
    with dropped_shuffles(docs.sparkSession):
        packs = stage(source.mapInArrow(_packed, _PACK), "packs")
        sizes = packs.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "taught")]).first()
        buckets = max(_BUCKETS, sizes.tokens // _BUCKET_TOKENS)

        def exchanged(asked: DataFrame, step: int) -> DataFrame:
            return stage(_exchanged(asked).withColumn("step", F.lit(step)), f"round_{step}")

        short, long = (exchanged(packs.mapInArrow(_counted(buckets, step), _ASKED), step) for step in (_SHORT, _LONG))
        distinct = short.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("n")).first().n
        counts, by_pack = short.union(long), packs.groupBy("pack")
        contexts = by_pack.cogroup(counts.groupBy("pack")).applyInArrow(_followed(buckets), _ASKED)
        told = counts.union(exchanged(contexts, _FOLLOWERS))
    scored = by_pack.cogroup(told.groupBy("pack")).applyInArrow(
        _scored(int(sizes.taught), int(distinct)),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
    return scored.withColumn("held_out", F.col("held_out") & F.col("doc_id").isNotNull())
