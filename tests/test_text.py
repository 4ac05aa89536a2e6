"""Text expressions on texts built from a known result, and against a back-reference expression."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from captide.functions import batches
from captide.functions import text as X


def repeats_once(text, longest=12):
    """Second opinion on collapse: one expression with a branch per phrase length, longest first."""
    phrases = (rf"((?:\S+ ){{{n - 1}}}\S+)(?: \{k})+(?!\S)" for k, n in enumerate(range(longest, 0, -1), 1))
    repeat = re.compile(rf"(?<!\S)(?:{'|'.join(phrases)})")
    return repeat.sub(lambda found: found[found.lastindex], " ".join(text.split()))


# What ends a line, what is white space within one, and what vanishes from one.
BREAKS = ["\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029"]
SPACES = [" ", "  ", "\t", "\x1f", "\xa0", "\u2003", "\u3000"]
MARKS = ["<c>", "</c>", "<00:00:01.5>", "<00:00:01.120>", "<\u0661\u0662:\u0663\u0664:\u0665\u0666.\u0667>"]
HEADERS = ["WEBVTT", "WEBVTTx", "Kind: captions", "Kind:", "Language: en <c>", "<c>Kind: x", " \tLanguage:"]
CUES = ["00:00:01.000 --> 00:00:02.500", "00:00:01.000-->00:00:02.500 align:start word",
        "<c>00:00:01.000\xa0-->\t00:00:02.500 &amp;"]
# Words as they are written and as they must come out.
WORDS = {w: w for w in ("word", "fox", "a", "b", "\xe9", "xKind:", "12:", ">", "<c.x>", "00:01.000", "\ufeff", "\u0661")} | {
    "&lt;c&gt;": "<c>",
    "&#39;": "'",
    "&copy": "\xa9",
    "&notit;": "\xacit;",
    "x&amp;y": "x&y",
    ">>": "\n>> ",
    "&gt;&gt;": "\n>> ",
    "&nbsp;": "\xa0",
}


def caption(pick, words=WORDS):
    """A caption file made from its known prose: markup, headers and cue ranges are added to it."""
    written, prose = [], []
    for _ in range(pick.randint(0, 6)):
        kind = pick.random()
        if kind < 0.25:
            written.append(pick.choice(HEADERS + CUES))
            continue
        line = []
        for word in pick.choices(list(words), k=pick.randint(0, 6)):
            # Words keep white space between them; marks may stand anywhere around.
            line += [pick.choice([*MARKS, ""]), word, pick.choice([*MARKS, ""]), pick.choice(SPACES)]
            prose.append(words[word])
        if kind < 0.4:
            line.append(pick.choice(CUES[:2]))
        written.append("".join(line))
    raw = "".join(line + pick.choice(BREAKS) for line in written)
    return raw, " ".join(prose)


@pytest.fixture(scope="module")
def made():
    pick = random.Random(11)
    return [caption(pick) for _ in range(4000)]


def apply(spark, expression, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = rows.select("id", expression(F.col("text")).alias("out")).collect()
    return [r.out for r in sorted(got)]


def test_cleaning_gives_back_the_prose(spark, made):
    assert apply(spark, X.clean_captions, [raw for raw, _ in made]) == [prose for _, prose in made]


def test_one_pass_transcript_equals_clean_then_collapse(spark, made):
    want = [repeats_once(prose) for _, prose in made]
    assert apply(spark, X.transcript_text, [raw for raw, _ in made]) == want


def test_markup_removal_in_spark_expressions_agrees(spark):
    pick = random.Random(12)
    same = {w: w for w, out in WORDS.items() if w == out}
    made = [caption(pick, same) for _ in range(2000)]
    assert apply(spark, X.strip_markup, [raw for raw, _ in made]) == [prose for _, prose in made]


def test_repeats_added_to_a_text_vanish():
    # Up to three times: four of a phrase are two of its double, which is longer.
    pick = random.Random(13)
    for _ in range(500):
        once = [f"w{k}" for k in range(pick.randint(1, 40))]
        start, times = pick.randrange(len(once)), pick.randint(2, 3)
        end = min(len(once), start + pick.randint(1, 12))
        repeated = once[:start] + once[start:end] * times + once[end:]
        assert batches.collapse(pa.array([" ".join(repeated)])).to_pylist() == [" ".join(once)]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("WEBVTT\nKind: captions\nLanguage: en\n\nHello\n", "Hello"),
        ("00:00:01.000 --> 00:00:03.000 align:start\nHello", "Hello"),
        ("kept 00:00:01.000 --> 00:00:03.000 gone", "kept"),
        ("So <00:00:01.500>there", "So there"),
        ("<c>we</c> go", "we go"),
        ("Tom &amp; Jerry &lt;here&gt;", "Tom & Jerry <here>"),
        (">> Hi &gt;&gt; Yo", "\n>>  Hi \n>>  Yo"),
        ("[Music]", "[Music]"),
        ("WEBVTT\n\n", ""),
        ("", ""),
    ],
)
def test_cleaning_cases(spark, raw, want):
    assert apply(spark, X.clean_captions, [raw]) == [want]


@pytest.mark.parametrize("longest", [1, 2, 3, 12])
def test_collapse_on_dense_repeats(longest):
    pick = random.Random(longest)
    texts = [
        " ".join(pick.choice("abcd"[: pick.randint(1, 4)]) for _ in range(pick.randint(0, 60)))
        for _ in range(5000)
    ]
    got = batches.collapse(pa.array(texts), longest).to_pylist()
    assert got == [repeats_once(t, longest) for t in texts]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("the fox the fox ran", "the fox ran"),
        ("no no no", "no"),
        ("a b c", "a b c"),
        ("The the", "The the"),
        ("go. go", "go. go"),
        ("x\n x\ty", "x y"),
        ("", ""),
        (None, None),
        (" ".join("abcdefghijklm" * 2), " ".join("abcdefghijklm" * 2)),
        (" ".join("abcdefghijkl" * 3), " ".join("abcdefghijkl")),
    ],
)
def test_collapse_cases(spark, text, want):
    assert apply(spark, X.collapse_phrases, [text]) == [want]


def test_collapse_keeps_texts_apart():
    assert batches.collapse(pa.array(["a b", "a b", None, "b", "b"])).to_pylist() == [
        "a b", "a b", None, "b", "b",
    ]


def test_long_text_and_small_slices(monkeypatch):
    pick = random.Random(5)
    texts = [" ".join(pick.choice("ab cd ef".split()) for _ in range(n)) for n in (30000, 0, 7, 900)]
    texts.append("w " * 20000 + "end")
    want = [repeats_once(t) for t in texts]
    texts = [" ".join(t.split()) for t in texts]
    for size in (1, 4 << 20):
        monkeypatch.setattr(batches, "_SLICE_BYTES", size)
        assert batches.collapse(pa.array(texts)).to_pylist() == want


def test_slices_are_bounded_whatever_the_order(monkeypatch):
    monkeypatch.setattr(batches, "_SLICE_BYTES", 100)
    found, work = [], batches._collapse_slice
    monkeypatch.setattr(batches, "_collapse_slice", lambda part, n: found.append(part) or work(part, n))
    texts = [""] * 500 + ["a" * 60, None, "b" * 39] + ["c c " * 20 + "c"] * 20 + ["d" * 300, "e"]
    got = batches.collapse(pa.array(texts)).to_pylist()
    assert got == [t if t is None else repeats_once(t) for t in texts]
    assert [t for part in found for t in part.to_pylist()] == texts
    assert all(len(part) == 1 or sum(len(t or "") for t in part.to_pylist()) <= 100 for part in found)


def test_results_leave_slice_by_slice(spark, monkeypatch):
    texts = ["a a b"] * 5000
    monkeypatch.setattr(batches, "_SLICE_BYTES", 10)
    sizes = [len(part) for part in batches.slice_by_slice(iter([pa.array(texts)] * 2), batches.collapse)]
    assert sizes == [2] * 5000
    assert list(batches.slice_by_slice(iter([pa.array([], pa.string())]), batches.collapse)) == []
    for clean in (X.collapse_words, X.clean_captions, X.transcript_text):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(["b b", None, "", "&amp;"])], "i int, t string")
        got = dict(rows.coalesce(1).select("i", clean(F.col("t")).alias("t")).collect())
        assert got[1] is None and got[2] == ""
        assert got[3] == ("&amp;" if clean is X.collapse_words else "&")


def test_word_count(spark):
    assert apply(spark, X.word_count, ["", "a", "a b c"]) == [0, 1, 3]
