"""Secrets in texts, in DataFrame functions only.

Three plain patterns give the base spans.  The method adds candidate strings, runs of one
character class, in which some window of ``WINDOW`` characters has a high Shannon entropy.
A window's entropy comes from its character counts, which are updated by the one character
that enters and the one that leaves.  Allow-listed candidates are never reported: those of a
public form are left out whole, and other allow-listed text is cut out of its run, so that a
key beside it is still found.

Positions come from marking the matches of a pattern with control characters (which no
pattern can match, so any in the text are first replaced by another of the same length),
cutting there, and adding up lengths.  Offsets are code points; ends are exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captide.llm.common import text_column

_OPEN, _CLOSE, _VALUE, _NEUTRAL = "\x01", "\x02", "\x04", "\x03"

# Patterns of the base kinds, the group whose length counts, least length.
BASE = (
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
)
WINDOW = 20
# Character classes of candidate strings, with the least entropy in bits of a window.
CLASSES = (
    ("entropy_hex", "0-9A-Fa-f", 3.0),
    ("entropy_base64", "A-Za-z0-9+/_-", 3.8),
)
# Candidates that are public by form: UUIDs, counting or alphabet runs, documented examples.
ALLOWED = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"(?i)0123456789|abcdefghijkl",
    r"(?i)example|placeholder|changeme",
)
# The documented secret key holds separators, so it is public as a whole only.
_FORMS = (ALLOWED[0], r"^wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY$")
# What is cut out: the part between separators that holds such a word, or the counting run.
_CUT = rf"(?<![A-Za-z0-9+])[A-Za-z0-9+]*(?:{ALLOWED[2]})[A-Za-z0-9+]*|{ALLOWED[1]}"
_ORDER = {name: at for at, name in enumerate([b[0] for b in BASE] + [c[0] for c in CLASSES])}
_SPAN = "array<struct<start:int,rank:int,stop:int,kind:string>>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that is computed once per row."""
    return F.transform(F.array(value), use)[0]


def _span(kind: str, start: Column, stop: Column) -> Column:
    return F.struct(
        start.cast("int").alias("start"),
        F.lit(_ORDER[kind]).alias("rank"),
        stop.cast("int").alias("stop"),
        F.lit(kind).alias("kind"),
    )


def _starts(lengths: Column) -> Column:
    """Where each part begins, from the lengths of all: sums over 1, 2, 4 and more parts before it.

    The rounds grow with the logarithm of the parts, each passing over them once.
    """

    def doubled(sums: Column, k: Column) -> Column:
        reach = F.pow(F.lit(2.0), k).cast("int")
        return F.transform(sums, lambda n, at: n + F.when(at >= reach, F.get(sums, at - reach)).otherwise(0))

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(lengths).cast("double"))).cast("int"))
    return F.zip_with(F.aggregate(rounds, lengths, doubled), lengths, lambda end, n: end - n)


def _placed(parts: Column, odd: bool) -> Column:
    """``start, match, value`` of the parts at odd or even places of a text cut at its matches."""

    def used(part: Column, at: Column) -> Column:
        return F.when(at % 2 == 1, F.substring_index(part, _VALUE, 1)).otherwise(part)

    def rows(starts: Column) -> Column:
        each = F.transform(
            parts,
            lambda part, at: F.struct(
                F.get(starts, at).alias("start"),
                used(part, at).alias("match"),
                F.substring_index(part, _VALUE, -1).alias("value"),
            ),
        )
        return F.filter(each, lambda _, at: at % 2 == int(odd))

    return bound(_starts(F.transform(parts, lambda part, at: F.length(used(part, at)))), rows)


def marked(text: Column, pattern: str, group: int = 0) -> Column:
    """``start, match, value`` of every leftmost match, in order; work grows with the matches."""
    nothing = F.array().cast("array<struct<start:int,match:string,value:string>>")
    cut = F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_VALUE}${group}{_CLOSE}"), f"[{_OPEN}{_CLOSE}]")
    return bound(cut, lambda parts: F.when(F.size(parts) > 1, _placed(parts, odd=True)).otherwise(nothing))


def between(text: Column, pattern: str) -> Column:
    """``start, match`` of what stands before, between and after the matches of a pattern."""
    cut = F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_OPEN}"), _OPEN)
    return bound(cut, lambda parts: _placed(parts, odd=False))


def base_spans(text: Column, kind: str) -> Column:
    _, pattern, group, least = next(b for b in BASE if b[0] == kind)
    if pattern.endswith("]+") and group == 0:
        # A run is matched whole, so shorter ones can be passed over by the pattern itself.
        head = len("AKIA") if kind == "access" else 0
        pattern = f"{pattern[:-1]}{{{least - head},}}"
    found = F.filter(marked(text, pattern, group), lambda m: F.length(m["value"]) >= least)
    return F.transform(found, lambda m: _span(kind, m["start"], m["start"] + F.length(m["match"])))


def _weight(count: Column) -> Column:
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(0.0)


def window_range(candidate: Column, least_entropy: float) -> Column:
    """``first, last``: the first and last window start that reach the entropy, or nulls."""
    # In terms of the sum of count * log2(count) over a window's characters.
    most = WINDOW * (math.log2(WINDOW) - least_entropy)

    def over(chars: Column) -> Column:
        head = F.slice(chars, 1, WINDOW)
        counts = F.map_from_entries(
            F.transform(
                F.array_distinct(chars),
                lambda c: F.struct(c, F.size(F.filter(head, lambda x: x == c))),
            )
        )

        def begin(counts: Column) -> Column:
            weight = F.aggregate(F.map_values(counts), F.lit(0.0), lambda s, n: s + _weight(n))
            return bound(
                weight,
                lambda w: F.struct(
                    counts.alias("counts"),
                    w.alias("weight"),
                    F.when(w <= most, 0).alias("first"),
                    F.when(w <= most, 0).alias("last"),
                ),
            )

        def step(state: Column, at: Column) -> Column:
            # Window ``at`` loses character at - 1 and gains character at + WINDOW - 1.
            gone, new = F.get(chars, at - 1), F.get(chars, at + (WINDOW - 1))
            n_gone, n_new = state["counts"][gone], state["counts"][new]
            weight = F.when(gone == new, state["weight"]).otherwise(
                state["weight"] - _weight(n_gone) - _weight(n_new) + _weight(n_gone - 1) + _weight(n_new + 1)
            )
            counts = F.when(gone == new, state["counts"]).otherwise(
                F.transform_values(
                    state["counts"],
                    lambda c, n: n + F.when(c == new, 1).when(c == gone, -1).otherwise(0),
                )
            )
            # A hair of slack for the rounding that updates add up.
            high = weight <= most + 1e-9
            return F.struct(
                counts.alias("counts"),
                weight.alias("weight"),
                F.when(high, F.coalesce(state["first"], at)).otherwise(state["first"]).alias("first"),
                F.when(high, at).otherwise(state["last"]).alias("last"),
            )

        later = F.when(
            F.size(chars) > WINDOW, F.sequence(F.lit(1), F.size(chars) - WINDOW)
        ).otherwise(F.array().cast("array<int>"))
        return F.aggregate(later, bound(counts, begin), step)

    return bound(F.split(candidate, ""), over)


def entropy_spans(text: Column, kind: str) -> Column:
    _, body, least_entropy = next(c for c in CLASSES if c[0] == kind)
    candidates = marked(text, f"(?<![{body}])[{body}]{{{WINDOW},}}+")
    private = F.filter(candidates, lambda m: ~F.regexp_like(m["match"], F.lit("|".join(_FORMS))))
    parts = F.flatten(
        F.transform(
            private,
            lambda m: F.transform(
                between(m["match"], _CUT),
                lambda p: F.struct((m["start"] + p["start"]).alias("start"), p["match"].alias("match")),
            ),
        )
    )
    ranged = F.transform(
        F.filter(parts, lambda p: F.length(p["match"]) >= WINDOW),
        lambda p: F.struct(p["start"].alias("start"), window_range(p["match"], least_entropy).alias("w")),
    )
    high = F.filter(ranged, lambda m: m["w"]["first"].isNotNull())
    return F.transform(
        high, lambda m: _span(kind, m["start"] + m["w"]["first"], m["start"] + m["w"]["last"] + WINDOW)
    )


def _written(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")),
        ),
        ",",
    )


def secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_name: str = "text") -> DataFrame:
    """``keep`` columns and the spans of each kind, as arrays of ``start, rank, stop, kind``.

    A null or empty text has none.  Spans of one kind never overlap; those of different
    kinds may.  Other columns are not read.  Repeated rows get equal results; an empty
    table gives an empty result.
    """
    # Control characters that serve as marks are no part of any pattern.
    neutral = F.translate(text_column(text_name), _OPEN + _CLOSE + _VALUE, _NEUTRAL * 3)
    rows = docs.select(*keep, neutral.alias("__text"))
    text = F.col("__text")
    found = [base_spans(text, b[0]).cast(_SPAN).alias(b[0]) for b in BASE]
    found += [entropy_spans(text, c[0]).cast(_SPAN).alias(c[0]) for c in CLASSES]
    return rows.select(*keep, *found)


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts and written spans per document."""
    base = [b[0] for b in BASE]
    found = secrets(docs)
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(_written(F.concat(*base)), 256).alias("base_sha256"),
        _written(F.concat(*_ORDER)).alias("spans"),
    )
