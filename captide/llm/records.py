"""Token ids as length-delimited binary records with a separate offset index.

A record frames one serialized sequence:

    length  8 bytes, little endian       masked CRC-32C of those 8 bytes, 4 bytes
    payload ``length`` bytes             masked CRC-32C of the payload, 4 bytes

so a reader finds damage to a length before it trusts it.  The payload is the document's
id (8 bytes), a byte that says whether the id is null, a byte with the width of a token
id (2 or 4), two zero bytes, and the token ids, little endian and unsigned.

Documents are dealt to tasks by ranges of their id, and each task streams its range into
one file, so files in order of their part number hold the documents in order.  A task
attempt writes a file of its own name and returns the index rows; only the rows of
attempts that Spark commits name a file, so retried and speculative tasks are harmless.
The index (one small Parquet row per record: file, offset, length, tokens before it)
lets any subset be read in any order.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from captide.llm.common import row_slices, share, shared, text_column
from captide.sources.staging import staging_path

# The polynomial of CRC-32C, reflected, and the constant that masks a checksum.
_POLYNOMIAL = 0x82F63B78
_MASK_DELTA = 0xA282EAD8
# White space as the tokenizer's pattern has it, and that pattern.
_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

END_ID = 0
# Bytes of records that one task reads, and that are read at once.
_BLOCK_BYTES = 16 << 20
_READ_BYTES = 8 << 20
# Text encoded together: the more, the more of its chunks are the same.
_ENCODED_BYTES = 16 << 20
# Remembered strings per generation, their longest, and marks that are pre-tokens of their own after a word.
_MEMO, _LONGEST = 250_000, 40
_MARKS = frozenset(".,;:!?")
# Parts whose token counts are summed together before the blocks are.
_PARTS = 4096
_LANE_BITS = 8

# Layouts: the length and its checksum, a checksum, the payload's head.
_FRAME, _CHECK, _HEAD = "<QI", "<I", "<qBBH"

INDEX = (
    "part int, file string, record long, offset long, length long, doc_id long, "
    "tokens_before long, n_tokens long"
)


# -- checksums ----------------------------------------------------------------------


class Checksums:
    """CRC-32C of many byte strings at once.

    A checksum is linear in the message, and appending zero bytes is a linear operator,
    kept as four tables of 256 per power of two.  Messages are cut into lanes of 256
    bytes that all advance together, four bytes a step; a message's lanes are then
    folded from left to right.
    """

    def __init__(self):
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
        values = np.arange(256, dtype=np.uint32)
        shifted = [values << np.uint32(8 * b) for b in range(4)]
        self._zeros = [np.stack([(x >> np.uint32(8)) ^ table[x & 0xFF] for x in shifted])]

    def _advance(self, x: np.ndarray, power: int) -> np.ndarray:
        """Checksum states after 2 ** power more zero bytes."""
        while len(self._zeros) <= power:
            last = len(self._zeros) - 1
            self._zeros.append(np.stack([self._advance(t, last) for t in self._zeros[last]]))
        t = self._zeros[power]
        return t[0][x & 0xFF] ^ t[1][(x >> 8) & 0xFF] ^ t[2][(x >> 16) & 0xFF] ^ t[3][x >> 24]

    def of(self, messages: list[bytes]) -> np.ndarray:
        if not messages:
            return np.zeros(0, np.uint32)
        lane = 1 << _LANE_BITS
        lengths = np.fromiter(map(len, messages), np.int64, len(messages))
        # Zeros in front leave a state of zero as it is, so whole lanes are filled up there.
        padded = b"".join([x for m in messages for x in (b"\0" * (-len(m) % lane), m)])
        words = np.frombuffer(padded, "<u4").reshape(-1, lane // 4)
        state = np.zeros(len(words), np.uint32)
        for step in range(lane // 4):
            state = self._advance(state ^ words[:, step], 2)
        lanes = -(-lengths // lane)
        first = np.cumsum(lanes) - lanes
        found = np.zeros(len(messages), np.uint32)
        longest = np.argsort(-lanes, kind="stable")
        counts = lanes[longest]
        for k in range(int(counts[0])):
            at = longest[: np.searchsorted(-counts, -k)]
            found[at] = self._advance(found[at], _LANE_BITS) ^ state[first[at] + k]
        start = np.full(len(messages), 0xFFFFFFFF, np.uint32)
        for power in range(int(lengths.max()).bit_length()):
            at = np.flatnonzero(lengths >> power & 1)
            start[at] = self._advance(start[at], power)
        return found ^ start ^ np.uint32(0xFFFFFFFF)

    def masked(self, messages: list[bytes]) -> np.ndarray:
        """Rotated and offset, so that data which holds checksums is checked as well as other data."""
        x = self.of(messages).astype(np.uint64)
        rotated = (x >> np.uint64(15)) | (x << np.uint64(17))
        return ((rotated + np.uint64(_MASK_DELTA)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


# -- token ids ----------------------------------------------------------------------


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Remembered(dict):
    """A bounded memory of two generations: what is still asked for outlives the older one."""

    def __init__(self):
        super().__init__()
        self.older: dict = {}

    def keep(self, key: str, value: bytes) -> None:
        if len(self) >= _MEMO:
            self.older = dict(self)
            self.clear()
        self[key] = value


class Encoder:
    """Token ids of whole texts by the tokenizers library, special tokens read as text.

    For a byte-level tokenizer without normaliser or added tokens that cut ordinary text,
    the library's model is asked once for each distinct pre-token it remembers.  A text
    may be cut before any space that a visible character follows, as no match of the
    pattern crosses that place; so words between spaces are remembered with their space.
    A text with other white space after a space is cut by the pattern from start to end.
    Any other tokenizer encodes each whole text itself.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._library = Tokenizer.from_str(tokenizer_json)
        self._library.encode_special_tokens = True
        self._model = self._library.model
        before = self._library.pre_tokenizer
        self._by_piece = (
            isinstance(before, pre_tokenizers.ByteLevel)
            and before.use_regex
            and not before.add_prefix_space
            and self._library.normalizer is None
            and self._library.truncation is None
            and self._library.padding is None
            and all(t.special for t in self._library.get_added_tokens_decoder().values())
        )
        self.width = 2 if self._library.get_vocab_size() <= 1 << 16 else 4
        self._kind = "H" if self.width == 2 else "I"
        self._letters = _byte_letters()
        self._cut = regex.compile(_PATTERN).findall
        self._white = re.compile(f"[{_WHITE}]").search
        self._blanks = frozenset(re.findall(f"[{_WHITE}]", "".join(map(chr, range(0x3001)))))
        # Ids of pre-tokens, and of a space with what follows up to the next one.
        self._pieces, self._chunks = Remembered(), Remembered()

    @classmethod
    def of_process(cls, tokenizer_json: str) -> Encoder:
        """The encoder a Python worker keeps for its later tasks, with what it remembers."""
        kept = vars(sys).setdefault("captide_encoders", {})
        if tokenizer_json not in kept:
            kept.clear()
            kept[tokenizer_json] = cls(tokenizer_json)
        return kept[tokenizer_json]

    def _piece(self, piece: str) -> bytes:
        found = self._pieces.get(piece)
        if found is None:
            found = self._pieces.older.get(piece) or self._asked(piece)
            if len(piece) <= _LONGEST:
                self._pieces.keep(piece, found)
        return found

    def _asked(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            # Of these only the space has another letter.
            spelt = piece.replace(" ", self._letters[32])
        else:
            spelt = piece.encode().decode("latin-1").translate(self._letters)
        return array(self._kind, [t.id for t in self._model.tokenize(spelt)]).tobytes()

    def _cut_up(self, text: str) -> bytes:
        return b"".join(map(self._piece, self._cut(text)))

    def _spaced(self, chunk: str) -> bytes:
        """Ids of a space and the chunk after it."""
        chunks = self._chunks
        found = chunks.older.get(chunk)
        if found is None:
            if chunk.isalpha():
                found = self._asked(" " + chunk)
            elif chunk[-1] in _MARKS and chunk[:-1].isalpha():
                word = chunk[:-1]
                found = (chunks.get(word) or self._spaced(word)) + self._piece(chunk[-1])
            elif "\n" in chunk:
                return self._lines(chunk)
            else:
                found = self._cut_up(" " + chunk)
        if len(chunk) <= _LONGEST:
            chunks.keep(chunk, found)
        return found

    def _lines(self, chunk: str) -> bytes:
        """Ids of a space and a chunk with line ends, which stand alone between visible characters."""
        first, *rest = chunk.split("\n")
        if not first or not all(rest) or self._white("".join([first, *rest])):
            return self._cut_up(" " + chunk)
        line_end = self._piece("\n")
        return (self._chunks.get(first) or self._spaced(first)) + b"".join([line_end + self._bare(part) for part in rest])

    def _bare(self, chunk: str) -> bytes:
        if chunk.isalpha():
            return self._piece(chunk)
        if chunk[-1] in _MARKS and chunk[:-1].isalpha():
            return self._piece(chunk[:-1]) + self._piece(chunk[-1])
        return self._cut_up(chunk)

    def encode(self, text: str) -> bytes:
        """Ids of one text, little endian, ``width`` bytes each."""
        if self._by_piece:
            return self._cut_up(text)
        ids = self._library.encode(text, add_special_tokens=False).ids
        return np.array(ids, f"<u{self.width}").tobytes()

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text.

        All chunks between spaces are found first; each distinct one is encoded once and
        the texts are put together from them.
        """
        if not self._by_piece:
            return [self.encode(t) for t in texts.to_pylist()]
        lists = pc.split_pattern(texts, " ")
        counts = np.diff(lists.offsets.to_numpy())
        told = lists.flatten().dictionary_encode()
        at, words = told.indices.to_numpy(), told.dictionary.to_numpy(zero_copy_only=False).tolist()
        known, spaced, blanks = self._chunks, self._spaced, self._blanks
        encoded = list(map(known.get, words))
        odd = np.zeros(len(words), bool)
        for k in [k for k, ids in enumerate(encoded) if ids is None]:
            word = words[k]
            if not word or word[0] in blanks:
                odd[k], encoded[k] = True, b""
            else:
                encoded[k] = spaced(word)
        # The first chunk of a text has no space before it.
        first = np.cumsum(counts) - counts
        heads = [self._cut_up(words[k]) for k in at[first]]
        at = at.copy()
        at[first] = len(words) + np.arange(len(first))
        sizes = np.fromiter(map(len, [*encoded, *heads]), np.int64, len(words) + len(heads)) // self.width
        pool = np.frombuffer(b"".join([*encoded, *heads]), f"<u{self.width}")
        starts = np.cumsum(sizes) - sizes
        each = sizes[at]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(at) else 0
        place = np.int32 if total < 1 << 31 else np.int64
        shift = (starts[at] - ends + each).astype(place)
        ids = pool[np.repeat(shift, each) + np.arange(total, dtype=place)]
        stops = (ends[first + counts - 1] * self.width).tolist() if len(at) else []
        raw = ids.tobytes()
        found = [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        strange = np.add.reduceat(np.append(odd, np.zeros(len(heads), bool))[at], first) if len(at) else []
        for k in np.flatnonzero(strange):
            found[k] = self._cut_up(texts[int(k)].as_py())
        return found


# -- writing ------------------------------------------------------------------------


def serialize(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return struct.pack(_HEAD, doc_id or 0, doc_id is None, width, 0) + ids


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, missing, width, _ = struct.unpack_from(_HEAD, payload)
    return None if missing else doc_id, np.frombuffer(payload, f"<u{width}", offset=struct.calcsize(_HEAD))


def frame(payloads: list[bytes], checksums: Checksums) -> list[bytes]:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    heads, bodies = checksums.masked(lengths).tolist(), checksums.masked(payloads).tolist()
    return [
        b"".join((length, struct.pack(_CHECK, head), payload, struct.pack(_CHECK, body)))
        for length, head, payload, body in zip(lengths, heads, payloads, bodies, strict=True)
    ]


def unframe(records: list[bytes], checksums: Checksums) -> list[bytes]:
    """Payloads of whole records; one whose length or checksums do not fit raises ValueError."""
    start, end = struct.calcsize(_FRAME), struct.calcsize(_CHECK)
    heads = [struct.unpack_from(_FRAME, r) for r in records]
    payloads = [r[start:-end] for r in records]
    bodies = [struct.unpack(_CHECK, r[-end:])[0] for r in records]
    lengths = [r[:8] for r in records]
    if (
        checksums.masked(lengths).tolist() != [h[1] for h in heads]
        or [len(p) for p in payloads] != [h[0] for h in heads]
        or checksums.masked(payloads).tolist() != bodies
    ):
        raise ValueError("a record is damaged")
    return payloads


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _record_folder(spark: SparkSession, folder: str) -> str:
    """Where record files are, with a scheme, as executors must name it: from a file Spark wrote."""
    found = spark.read.parquet(f"{folder}/made").select("_metadata.file_path").first()[0]
    return found.rsplit("/made/", 1)[0] + "/records"


def write_records(
    docs: DataFrame, tokenizer_json: str, folder: str, id_column: str = "doc_id", text_name: str = "text"
) -> DataFrame:
    """Write every whole text's token ids and an end id, by ascending id; returns the index.

    ``folder`` must be one that executors and driver share; record files go to
    ``folder/records``, the index to ``folder/index``.  A null text counts as empty and
    has the end id only.  Null ids come first; rows of one id go by a hash of their text,
    rows equal in both in any order, and either may be spread over several files.  Other
    columns are not read.  An empty table gives an empty index and no files.

    The rows are moved once, before they are encoded.
    """
    spark = docs.sparkSession
    spark.range(1).coalesce(1).write.parquet(f"{folder}/made")
    model = share(spark, tokenizer_json, _record_folder(spark, folder))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text_column(text_name).alias("text"))
    rows = rows.withColumns({"hash": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange("id", "hash", "row").sortWithinPartitions("id", "hash").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, target = shared(model)
        encoder, checksums = Encoder.of_process(tokenizer), Checksums()
        end = array("H" if encoder.width == 2 else "I", [END_ID]).tobytes()
        system, place = _place(target)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
        out, offset, record, tokens = None, 0, 0, 0
        for whole in batches:
            for batch in row_slices(whole, most=_ENCODED_BYTES):
                if out is None:
                    system.create_dir(place, recursive=True)
                    out = system.open_output_stream(f"{place}/{name}")
                ids = batch.column(0).to_pylist()
                sequences = [ids + end for ids in encoder.encode_all(batch.column(1))]
                framed = frame([serialize(i, s, encoder.width) for i, s in zip(ids, sequences, strict=True)], checksums)
                out.write(b"".join(framed))
                lengths = np.fromiter(map(len, framed), np.int64, len(framed))
                counts = np.fromiter(map(len, sequences), np.int64, len(framed)) // encoder.width
                n = len(framed)
                yield pa.record_batch(
                    [
                        pa.array(np.full(n, part, np.int32)),
                        pa.array([name] * n, pa.string()),
                        pa.array(np.arange(record, record + n)),
                        pa.array(offset + np.cumsum(lengths) - lengths),
                        pa.array(lengths),
                        batch.column(0),
                        pa.array(tokens + np.cumsum(counts) - counts),
                        pa.array(counts),
                    ],
                    names=[f.split()[0] for f in INDEX.split(", ")],
                )
                offset, record, tokens = offset + int(lengths.sum()), record + n, tokens + int(counts.sum())
        if out is not None:
            # Rows reach the index only if the task ends, and so only with a whole file.
            out.close()

    ordered.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


# -- reading ------------------------------------------------------------------------


def read_records(
    index: DataFrame,
    folder: str,
    then: Callable[[pa.RecordBatch], pa.RecordBatch] = lambda batch: batch,
    schema: str = "doc_id long, start long, ids array<int>",
) -> DataFrame:
    """``doc_id, start, ids`` of the records that ``index`` names, any subset of its rows.

    ``then`` may turn each batch of them into one of ``schema`` in the same task.

    ``index`` is that of ``write_records`` with ``start``, as ``with_starts`` adds it.
    Ids and token ids come from the record files, whose checksums are tested; damage, or a
    record that is not the one the index says, fails the read.  Neighbouring records are
    read together, in blocks spread over tasks by their bytes.
    """
    spark = index.sparkSession
    source = share(spark, _record_folder(spark, folder))
    blocks = index.withColumn("block", F.floor(F.col("offset") / _BLOCK_BYTES))
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // _BLOCK_BYTES))
    dealt = (
        blocks.repartition(int(tasks), "part", "block")
        .sortWithinPartitions("part", "offset")
        .select("file", "offset", "length", "doc_id", "start")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (place,) = shared(source)
        system, root = _place(place)
        checksums, name, stream = Checksums(), None, None
        for batch in batches:
            rows = list(zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True))
            start = 0
            while start < len(rows):
                file, first, size, _ = rows[start]
                stop, until = start + 1, first + size
                while stop < len(rows) and rows[stop][:2] == (file, until) and until - first < _READ_BYTES:
                    until, stop = until + rows[stop][2], stop + 1
                if file != name:
                    if stream is not None:
                        stream.close()
                    name, stream = file, system.open_input_file(f"{root}/{file}")
                raw = stream.read_at(until - first, first)
                found = rows[start:stop]
                payloads = unframe([raw[o - first : o - first + n] for _, o, n, _ in found], checksums)
                parsed = [parse(p) for p in payloads]
                ids = [p[0] for p in parsed]
                if ids != [r[3] for r in found]:
                    raise ValueError(f"{file} does not hold the documents its index names")
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum([len(p[1]) for p in parsed])]), pa.int32()),
                    pa.array(np.concatenate([p[1] for p in parsed]).astype(np.uint32).view(np.int32)),
                )
                begins = batch.column(4).slice(start, stop - start)
                yield then(pa.record_batch([pa.array(ids, pa.int64()), begins, lists], names=["doc_id", "start", "ids"]))
                start = stop
        if stream is not None:
            stream.close()

    return dealt.mapInArrow(run, schema)


def with_starts(index: DataFrame) -> DataFrame:
    """``index`` and ``start``, the token ids of all documents before a record's.

    Parts are summed in groups first, so the window without a partition sees one row per
    ``_PARTS`` files.
    """
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("group", F.floor(F.col("part") / _PARTS))
    earlier = (W.unboundedPreceding, -1)
    groups = parts.groupBy("group").agg(F.sum("n").alias("of_group")).select(
        "group", F.coalesce(F.sum("of_group").over(W.orderBy("group").rowsBetween(*earlier)), F.lit(0)).alias("base")
    )
    inside = F.coalesce(F.sum("n").over(W.partitionBy("group").orderBy("part").rowsBetween(*earlier)), F.lit(0))
    before = parts.withColumn("inside", inside).join(groups, "group").select("part", (F.col("base") + F.col("inside")).alias("before"))
    return index.join(before, "part").withColumn("start", F.col("before") + F.col("tokens_before")).drop("before")


def token_report(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from record files written and read back.

    ``start`` counts the token ids of all documents before it, end ids too, and
    ``ids_crc32`` is that of all its ids as little-endian unsigned 32-bit integers.
    """
    folder = staging_path(docs.sparkSession, "tokens")
    index = with_starts(write_records(docs, tokenizer_json, folder))

    def digested(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(2)
        at = lists.offsets.to_pylist()
        raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at, at[1:], strict=False)]
        columns = [*batch.columns[:2], pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64())]
        return pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_records(index, folder, digested, "doc_id long, start long, n_tokens long, ids_crc32 long")
