"""Whitening, token records and conversation repair against brute-force versions."""

import hashlib
import itertools
import random
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from captide.llm import records, repair, whitening
from captide.llm.queries import QUERIES
from captide.sources.staging import staging_path

TOKENIZER = Path(P.path("byte_bpe_50k.json")).read_text()


# -- whitening ----------------------------------------------------------------------


def whitened_by_hand(vectors, count=8):
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    centred = np.array(x, float) - np.array(sums, float) / n
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:count]
    values, vectors = values[order], vectors[:, order]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    return deviations, centred @ vectors / np.sqrt(values), values / np.trace(v)


def compare(found, ids, vectors):
    deviations, white, explained = whitened_by_hand(vectors)
    rows = {(r.vec_id, r.component): r for r in found}
    assert len(rows) == len(found) == white.size
    for k in range(white.shape[1]):
        ours = np.array([rows[i, k + 1].whitened for i in ids])
        sign = np.sign(ours @ white[:, k])
        assert np.allclose(ours, sign * white[:, k], atol=1e-8)
    for at, i in enumerate(ids):
        assert rows[i, 1].deviation == deviations[at] and rows[i, 1].n == len(ids)
    assert np.allclose([rows[ids[0], k + 1].explained for k in range(white.shape[1])], explained)
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-6


def test_whitening_of_the_given_table(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    found = QUERIES["op11_whitening"](spark, sf_dir).collect()
    compare(found, [r.vec_id for r in given], [r.embedding for r in given])


def test_whitening_leaves_out_what_it_cannot_place(spark):
    numbers = np.random.default_rng(2).standard_normal((40, 5)).tolist()
    odd = [None, [None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0], [], [1e300] * 5]
    rows = [(i, v, 1, 2) for i, v in enumerate([*numbers, *odd])]
    schema = "vec_id long, embedding array<double>, n int, c int"
    found = whitening.whiten(spark.createDataFrame(rows, schema).repartition(3)).collect()
    compare(found, list(range(40)), numbers)
    assert len(found) == 40 * 5


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 4, [[], []]])
def test_nothing_varies(spark, vectors):
    docs = spark.createDataFrame([(1, v) for v in vectors], "vec_id long, embedding array<float>")
    assert whitening.whiten(docs).collect() == []


def test_repeated_rows_count_and_large_sums_stay_exact(spark):
    vectors = [[0.5e9, 1.0], [0.5e9, 1.0], [-4e12, 2.0], [3.0, -7.5]]
    docs = spark.createDataFrame([(None, v) for v in vectors], "vec_id long, embedding array<double>")
    found = whitening.whiten(docs).where("component = 1").collect()
    deviations, _, _ = whitened_by_hand(vectors, 2)
    want = [d if d < 1 << 63 else None for d in deviations]
    assert sorted(map(str, (r.deviation for r in found))) == sorted(map(str, want)) and len(found) == 4


def test_components_of_close_and_equal_eigenvalues():
    numbers = np.random.default_rng(5)
    q, _ = np.linalg.qr(numbers.standard_normal((30, 30)))
    for values in ([5.0] * 9 + [1.0] * 21, 1 + 1e-13 * np.arange(30), [1e9] + [1e-3] * 29, np.arange(30.0)):
        matrix = (q * np.array(values)) @ q.T
        matrix = (matrix + matrix.T) / 2
        found, vectors = whitening.leading_components(matrix, 12)
        assert np.allclose(found, np.linalg.eigvalsh(matrix)[::-1][:12], rtol=0, atol=1e-14 * np.max(np.abs(values)) * 30)
        assert np.abs(vectors @ vectors.T - np.eye(12)).max() < 1e-12
        assert np.abs(matrix @ vectors.T - vectors.T * found).max() < 1e-13 * np.max(np.abs(values)) * 30


# -- token records ------------------------------------------------------------------


def crc32c_by_hand(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ 0x82F63B78 * (crc & 1)
    return crc ^ 0xFFFFFFFF


def test_checksums_equal_the_bitwise_definition():
    numbers = random.Random(1)
    messages = [numbers.randbytes(n) for n in (0, 1, 3, 4, 8, 255, 256, 257, 1000, 5000)] + [b"123456789"]
    sums = records.Checksums()
    assert sums.of(messages).tolist() == [crc32c_by_hand(m) for m in messages]
    assert sums.of([b"123456789"])[0] == 0xE3069283


def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_str(TOKENIZER)
    found.encode_special_tokens = True
    return found


SPACED = [
    "a  b", " a", "a ", "a\n\nb", "a \nb", "a\n b", "\t a\t\tb  \n c ", "a\x1cb \x1d c", "x  y z", "it's don't 'Re",
    "<|endoftext|> and <|endoftext|>", "é́ 日本語 123 4,5", "😀 " * 3, "  a b", "\r\n a \r\n", "'" * 9 + "s", "\0 a\0",
]


def test_ids_are_those_of_the_library_for_whole_texts(spark, sf_dir):
    numbers = random.Random(4)
    mixed = ["".join(numbers.choices(" \n\t'.,sx1é 　\x1c", k=30)) for _ in range(2000)]
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    encoder, whole = records.Encoder(TOKENIZER), library()
    texts = [*SPACED, *mixed, *texts, "", "w" * 5000, " "]
    expected = [whole.encode(text, add_special_tokens=False).ids for text in texts]
    for _ in range(2):
        found = encoder.encode_all(pa.array(texts))
        assert [np.frombuffer(ids, "<u2").tolist() for ids in found] == expected
    assert [np.frombuffer(encoder.encode(text), "<u2").tolist() for text in texts] == expected
    assert [encoder.encode_all(pa.array([text])) for text in SPACED] == [[encoder.encode(text)] for text in SPACED]
    assert encoder.encode_all(pa.array([], pa.string())) == []


def test_pieces_are_spelt_alike_whether_plain_or_not():
    encoder, whole = records.Encoder(TOKENIZER), library()
    ends = ["", "\x7f", "\t", "\0", "\x1f", "\xa0", "\xad", "é", "~", " "]
    texts = [f"{a}plain {b}word{a} {a}{b}" for a in ends for b in ends]
    expected = [whole.encode(text, add_special_tokens=False).ids for text in texts]
    for found in (encoder.encode_all(pa.array(texts)), [encoder.encode(text) for text in texts]):
        assert [np.frombuffer(ids, "<u2").tolist() for ids in found] == expected


def test_a_small_memory_changes_nothing(monkeypatch, spark, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    expected = records.Encoder(TOKENIZER).encode_all(pa.array(texts))
    monkeypatch.setattr(records, "_MEMO", 50)
    assert records.Encoder(TOKENIZER).encode_all(pa.array(texts)) == expected


def test_a_tokenizer_that_is_not_byte_level_encodes_whole_texts():
    json = Path(P.path("word_bpe_49k.json")).read_text()
    encoder, texts = records.Encoder(json), ["Hello  there", "", "a\nb"]
    from tokenizers import Tokenizer

    plain = Tokenizer.from_str(json)
    plain.encode_special_tokens = True
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(ids, f"<u{encoder.width}").tolist() for ids in encoder.encode_all(pa.array(texts))] == expected


def report_by_hand(rows):
    whole, start, found = library(), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def test_token_records_of_the_given_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_token_records"](spark, sf_dir).collect())) == sorted(report_by_hand(rows))


def test_token_records_of_awkward_rows(spark):
    rows = [(3, "b"), (None, "x y"), (1, None), (2, ""), (7, "long " * 20000), (9, "same"), (9, "same"), (9, "same")]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, part int, offset string")
    found = [tuple(r) for r in records.token_report(docs.repartition(4), TOKENIZER).collect()]
    assert sorted(found, key=lambda r: r[1]) == report_by_hand(rows)
    assert records.token_report(docs.limit(0), TOKENIZER).collect() == []


def test_records_are_framed_read_in_any_order_and_damage_is_found(spark):
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 7)) for i in range(200)], "doc_id long, text string")
    folder = staging_path(spark, "records")
    index = records.with_starts(records.write_records(docs.repartition(3), TOKENIZER, folder))
    some = index.where("doc_id % 3 = 1").orderBy("length")
    whole = library()
    read = {r.doc_id: r.ids for r in records.read_records(some, folder).collect()}
    assert read == {i: [*whole.encode(f"text {i} " * (i % 7)).ids, 0] for i in range(1, 200, 3)}
    files = sorted(Path(folder.removeprefix("file://")).glob("records/*.rec"))
    raw = files[0].read_bytes()
    length = int.from_bytes(raw[:8], "little")
    masked = lambda data: ((c := crc32c_by_hand(data)) >> 15 | c << 17 & 0xFFFFFFFF) + 0xA282EAD8 & 0xFFFFFFFF
    assert int.from_bytes(raw[8:12], "little") == masked(raw[:8])
    assert int.from_bytes(raw[12 + length : 16 + length], "little") == masked(raw[12 : 12 + length])
    sums = records.Checksums()
    (record,) = records.frame([b"payload"], sums)
    assert records.unframe([record], sums) == [b"payload"]
    for at in range(len(record)):
        with pytest.raises(ValueError):
            records.unframe([record[:at] + bytes([record[at] ^ 4]) + record[at + 1 :]], sums)


# -- conversation repair --------------------------------------------------------------


def damaged_by_hand(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        for _ in range({0: 0, 3: 2}.get(kind, 1)):
            yield conv, turn, "user" if kind == 4 else role, text


def faults_by_hand(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        found.append("b" if not visible else "d" if (role, text) in seen else "" if visible[-1] in ".!?" else "t")
        seen.add((role, text))
    return found


def best_by_hand(rows, faults):
    """The best of all edit lists that are not dearer than one found before."""
    best = None
    proper = re.compile("(s?(ua)+)?")

    def extend(at, cost, audit, initials, lines):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        text = "".join(initials)
        if not re.fullmatch("(s?(ua)*u?)?", text):
            return
        if at == len(rows) and proper.fullmatch(text):
            candidate = (cost, audit, "\n".join(lines))
            best = candidate if best is None else min(best, candidate)
        for role in ("user", "assistant"):
            if not audit.endswith("III"):
                extend(at, cost + repair.INSERT, audit + "I", [*initials, role[0]], [*lines, f"{role}:"])
        if at < len(rows):
            _, _, role, content = rows[at]
            extend(at + 1, cost + 2, audit + "D", initials, lines)
            if faults[at] not in ("b", "d"):
                left = 5 * (faults[at] == "t")
                extend(at + 1, cost + left, audit + "K", [*initials, role[:1] or " "], [*lines, f"{role}:{content}"])
                for new in ("user", "assistant"):
                    extend(at + 1, cost + left + 1, audit + "R", [*initials, new[0]], [*lines, f"{new}:{content}"])

    extend(0, 0, "", [], [])
    return best


def repaired_by_hand(rows):
    found = {}
    rows = sorted(rows, key=lambda r: str(r[0]))
    for conv, given in itertools.groupby(rows, key=lambda r: r[0]):
        hashed = lambda t: hashlib.sha256(t.encode()).hexdigest()
        left = sorted(
            damaged_by_hand(given), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashed(r[3]))
        )
        faults = faults_by_hand(left)
        turns = {r[1] for r in left} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[2][:1] or " " for r in left]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, text = best_by_hand(left, faults)
        counts = (faults.count("b"), faults.count("d"), faults.count("t"), illegal)
        found[conv] = (conv, gaps, *counts, cost, audit, hashed(text))
    return found


def repaired(spark, rows, schema="conv_id long, turn long, role string, text string"):
    frame = spark.createDataFrame(rows, schema).repartition(3)
    return {r.conv_id: tuple(r) for r in repair.repair(repair.damage(frame)).collect()}


def test_repair_of_the_given_table(spark, sf_dir):
    given = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    found = {r.conv_id: tuple(r) for r in QUERIES["op13_conversation_repair"](spark, sf_dir).collect()}
    assert found == repaired_by_hand(given)


def odd_conversations(seed, count):
    numbers = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", " \n", None, "So on", "Yes. "]
    for conv in range(count):
        for turn in range(numbers.randint(1, 6)):
            role = numbers.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            yield conv, numbers.choice([turn, turn, turn, None, 2]), role, numbers.choice(texts)


def test_repair_of_odd_conversations(spark):
    rows = [*odd_conversations(11, 150), (None, 1, "user", "Hi."), (None, None, "assistant", "Hi."), (7000, 3, "user", "Hi!")]
    found = repaired(spark, rows)
    assert found == repaired_by_hand(rows)


@pytest.mark.parametrize("cost", [5, 2, 1])
def test_edits_are_the_cheapest_with_inserted_rows_too(monkeypatch, cost):
    """At the given costs a deletion is as good as any insertion; cheaper ones are used."""
    monkeypatch.setattr(repair, "INSERT", cost)
    used = 0
    for _, given in itertools.groupby(odd_conversations(13, 120), key=lambda r: r[0]):
        rows = [(c, t, role or " ", text or " ") for c, t, role, text in given]
        faults = faults_by_hand(rows)
        kinds = {"b": repair.BLANK, "d": repair.DUPLICATE, "t": repair.CUT, "": repair.WHOLE}
        search = repair.Search()
        for row, fault in zip(rows, faults, strict=True):
            search.row(row[2][:1], kinds[fault])
        found, audit = search.result()
        best = best_by_hand(rows, faults)
        assert (found, audit) == best[:2]
        rebuilt = repair.Rebuilt(audit)
        for row in rows:
            rebuilt.row(*row[2:])
        assert rebuilt.digest() == hashlib.sha256(best[2].encode()).hexdigest()
        used += "I" in audit
    assert (used > 0) == (cost < repair.DELETE)


def test_colliding_hashes_do_not_change_the_edits(monkeypatch):
    rows = list(odd_conversations(12, 200))

    def edits():
        found = []
        for _, given in itertools.groupby(rows, key=lambda r: r[0]):
            search = repair.Search()
            for _, _, role, text in given:
                search.row((role or " ")[:1], repair.WHOLE if len(text or "") % 2 else repair.CUT)
            found.append(search.result())
        return found

    expected = edits()
    for modulus in (1, 2, 3):
        monkeypatch.setattr(repair, "_MODULUS", modulus)
        assert edits() == expected


def test_a_long_conversation_and_an_empty_table(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", f"{t}.") for t in range(20000)]
    (found,) = repaired(spark, rows).values()
    assert found[1] > 0 and found[5] > 0 and found[6] > 0
    roles = {t: r for _, t, r, _ in rows}
    assert len(found[7]) >= len(roles) * 0.9
    assert repaired(spark, []) == {}
    extra = [(1, 0, "user", "Hi.", "x", 1), (1, 1, "assistant", "Oh.", "y", 2)]
    found = repaired(spark, extra, "conv_id long, turn long, role string, text string, conv string, audit int")
    assert set(found) == {1}
