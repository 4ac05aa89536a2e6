"""Byte-level BPE with a two-tier lookup.

A text is cut into pre-tokens by the vocabulary's pattern.  Tier one looks a whole
pre-token up in a minimal perfect hash of the vocabulary (hash and displace: 8-byte
fingerprints in a table without holes, checked against the stored bytes).  Tier two,
for pre-tokens that are no token, keeps the bytes as a doubly linked list and the ranks
of neighbouring pairs in a heap; popping the least rank, leftmost first, merges a pair
and pushes the two new neighbours, so a pre-token of n bytes costs O(n log n) however
long it is.  The perfect hash is built once, on the driver, and broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.llm.common import row_slices, share, shared, text_column

# Remembered pre-tokens per task.
_MEMO = 400_000
_MASK = (1 << 64) - 1


class PerfectHash:
    """Minimal perfect hash from byte strings to ranks, built by hash and displace.

    Keys are dealt into buckets; from the largest bucket on, the first displacement that
    sends all of a bucket's keys to free slots is taken.  A lookup reads one displacement
    and one slot.  The slot's key is compared, so a string outside the set is never found.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.size = len(ranks)
        self._buckets = max(1, self.size // 3)
        keys = list(ranks)
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32)
        bucket = (low % np.uint64(self._buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self._buckets)
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        taken = bytearray(self.size)
        self._shift = [0] * self._buckets
        slots = [0] * self.size
        lows, highs, order = low.tolist(), high.tolist(), order.tolist()
        for b in np.argsort(-counts, kind="stable").tolist():
            if not counts[b]:
                break
            inside = order[starts[b] : starts[b] + counts[b]]
            d = 0
            while True:
                at = [self._slot(lows[i], highs[i], d) for i in inside]
                if len(set(at)) == len(at) and not any(taken[s] for s in at):
                    break
                d += 1
            self._shift[b] = d
            for i, s in zip(inside, at, strict=True):
                taken[s] = 1
                slots[s] = i
        self._keys = [keys[i] for i in slots]
        self._ranks = [ranks[k] for k in self._keys]

    def _slot(self, low: int, high: int, d: int) -> int:
        # A fresh multiplicative hash of the key for each displacement.
        return (((high + d * 0x9E3779B1) * (low | 1) * 0x9E3779B97F4A7C15 & _MASK) >> 29) % self.size

    def get(self, key: bytes) -> int:
        """Rank of a key, -1 for any other string."""
        h = xxhash.xxh3_64_intdigest(key)
        low = h & 0xFFFFFFFF
        slot = self._slot(low, h >> 32, self._shift[low % self._buckets])
        return self._ranks[slot] if self._keys[slot] == key else -1


class Merger:
    """Tier two: merges the bytes of a pre-token that is no token."""

    def __init__(self, ranks: dict[bytes, int]):
        self._rank = ranks.get
        self._single = [ranks[bytes([b])] for b in range(256)]
        self._pairs = [[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)]

    def ids(self, piece: bytes) -> list[int]:
        """Token ids by merging the neighbours of least rank, leftmost first."""
        n, rank, pairs = len(piece), self._rank, self._pairs
        shift = n.bit_length()
        mask = (1 << shift) - 1
        ids = [self._single[b] for b in piece]  # of the part that starts here; -1 once merged away
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        joint = [pairs[a][b] for a, b in zip(piece, piece[1:], strict=False)] + [-1]
        heap = [r << shift | at for at, r in enumerate(joint) if r >= 0]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            least = pop(heap)
            at, r = least & mask, least >> shift
            if joint[at] != r:  # one of the two parts has been merged since
                continue
            middle = after[at]
            stop = after[at] = after[middle]
            ids[at], ids[middle], joint[middle] = r, -1, -1
            if stop < n:
                before[stop] = at
                new = joint[at] = rank(piece[at : after[stop]], -1)
                if new >= 0:
                    push(heap, new << shift | at)
            else:
                joint[at] = -1
            left = before[at]
            if left >= 0:
                new = joint[left] = rank(piece[left:stop], -1)
                if new >= 0:
                    push(heap, new << shift | left)
        return [i for i in ids if i >= 0]


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, table: PerfectHash, ranks: dict[bytes, int], pattern: str):
        self._table = table
        self._merge = Merger(ranks).ids
        self._bytes = {rank: token for token, rank in ranks.items()}
        self._cut = regex.compile(pattern).findall
        self._memo: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode()
        whole = self._table.get(raw)
        ids = [whole] if whole >= 0 else self._merge(raw)
        found = array("I", ids).tobytes()
        if len(raw) <= 64:
            self._memo[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        memo, work = self._memo, self._piece
        if len(memo) > _MEMO:
            memo.clear()
        return b"".join([memo.get(p) or work(p) for p in self._cut(text)])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep: tuple[str, ...] = (), digests: bool = False
) -> DataFrame:
    """Token ids of every whole text, and the text decoded from them again.

    Returns ``keep`` columns, then ``n_tokens`` and either ``ids array<int>, decoded
    binary`` or, with ``digests``, their SHA-256 as lowercase hex.  A null text counts as
    empty and has no tokens.  The vocabulary (bounded: one file) travels as a broadcast.
    Only named columns are read, so others may have any name; repeated rows are encoded
    like any other.  An empty table gives an empty result.
    """
    vocabulary = share(docs.sparkSession, PerfectHash(ranks), ranks, pattern)
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], text_column().alias("text"))
    kept = source.schema.fields[:-1]
    results = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary"
    schema = ", ".join([f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(kept)] + ["n_tokens long", results])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared(vocabulary))
        for whole in batches:
            for batch in row_slices(whole, column=len(kept)):
                ids = [codec.encode(t) for t in batch.column(len(kept)).to_pylist()]
                back = [codec.decode(i) for i in ids]
                if digests:
                    results = [
                        pa.array([hashlib.sha256(x).hexdigest() for x in column]) for column in (ids, back)
                    ]
                else:
                    results = [
                        pa.array([np.frombuffer(i, "<i4") for i in ids], pa.list_(pa.int32())),
                        pa.array(back, pa.binary()),
                    ]
                counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                columns = [*batch.columns[: len(kept)], counts, *results]
                names = [*batch.schema.names[: len(kept)], "n_tokens"]
                names += ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
                yield pa.record_batch(columns, names=names)

    encoded = source.mapInArrow(run, schema)
    renamed = [F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]
    return encoded.select(*renamed, *encoded.columns[len(kept) :])
