"""Caption text cleaning as column expressions.

Markup removal works on whole texts instead of splitting into lines: every
pattern stays inside one line by its character classes, so no per-line arrays are
built.  ``strip_markup`` is built from Spark's own expressions.  What needs entity
decoding or phrase collapse has to visit Python once, and then does all its
cleaning there, on Arrow batches with the same patterns; results leave a slice at a
time, so that a worker holds a batch and not its results too.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from captide.functions import batches
from captide.functions.batches import MAX_NGRAM

# Workers get the batch functions inside the task, so the package need not be
# installed on executors.
cloudpickle.register_pickle_by_value(batches)

# All white space.  Java's class is cheap to test but leaves out four separators.
_SPACE = r"[\s\x1c-\x1f]"
# Java's line start covers the other line breaks.
_HEADER_LINE = batches.header_line(r"\x0b\x0c\x1c-\x1e")


def strip_cue_ranges(text: Column) -> Column:
    return F.regexp_replace(text, batches.CUE_RANGE, "")


def strip_inline_timestamps(text: Column) -> Column:
    return F.regexp_replace(text, batches.INLINE_TIMESTAMP, "")


def strip_caption_tags(text: Column) -> Column:
    return F.regexp_replace(text, batches.CAPTION_TAG, "")


def drop_header_lines(text: Column) -> Column:
    return F.regexp_replace(text, _HEADER_LINE, "")


def normalise_spaces(text: Column) -> Column:
    """One blank between words, none at the ends, any Unicode white space."""
    return F.trim(F.regexp_replace(text, f"(?U){_SPACE}+", " "))


def trim_spaces(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, f"(?U)^{_SPACE}++|(?<!{_SPACE}){_SPACE}++\\z", "")


def strip_markup(raw: Column) -> Column:
    """Raw caption file text to one line of prose, entities still encoded."""
    for step in (
        strip_cue_ranges,
        strip_inline_timestamps,
        strip_caption_tags,
        drop_header_lines,
        normalise_spaces,
    ):
        raw = step(raw)
    return raw


def clean_captions(raw: Column) -> Column:
    """Raw caption file text to prose with a line break before each speaker mark."""

    @F.arrow_udf("string")
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return batches.slice_by_slice(texts, batches.clean)

    return clean(raw)


def collapse_words(text: Column, max_ngram: int = MAX_NGRAM) -> Column:
    """``collapse_phrases`` for a text that is single-spaced already."""

    @F.arrow_udf("string")
    def collapse(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return batches.slice_by_slice(texts, lambda part: batches.collapse(part, max_ngram))

    return collapse(text)


def collapse_phrases(text: Column, max_ngram: int = MAX_NGRAM) -> Column:
    """Emit each consecutively repeated phrase of up to ``max_ngram`` words once."""
    return collapse_words(normalise_spaces(text), max_ngram)


def transcript_text(raw: Column) -> Column:
    """``collapse_phrases(clean_captions(raw))`` in one pass."""

    @F.arrow_udf("string")
    def finish(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return batches.slice_by_slice(texts, batches.finish)

    return finish(raw)


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def word_count(text: Column) -> Column:
    """Words in a single-spaced text."""
    return F.when(text == "", 0).otherwise(
        F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1
    )
