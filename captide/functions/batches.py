"""Text work on Arrow batches, and the patterns of caption markup.

The patterns are written for both Java's and Arrow's regular expressions.

Phrase collapse: a phrase of ``n`` words repeats at word ``i`` exactly when word
``i + k`` equals word ``i + k + n`` for the next ``n`` values of ``k``.  For one
``n`` that is a run of equal pairs, so every repeat in a batch is found with
``max_ngram`` array comparisons over dictionary codes.  Only the final
left-to-right choice among the found repeats is sequential, and it steps from
repeat to repeat, not from word to word.
"""

from __future__ import annotations

import html
from collections.abc import Callable, Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs

# Longest phrase looked for, in words.
MAX_NGRAM = 12

# Characters that end a line, other white space, decimal digits.
LINE_BREAKS = r"\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}"
IN_LINE_SPACES = r"\t\x1f \x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}"
DIGIT = r"\p{Nd}"
# First words of caption file header lines.
HEADER_PREFIXES = ("WEBVTT", "Kind:", "Language:")

_REST_OF_LINE = f"[^{LINE_BREAKS}]*"
_CLOCK = f"{DIGIT}{{2}}:{DIGIT}{{2}}:{DIGIT}{{2}}\\."

CUE_RANGE = (
    f"{_CLOCK}{DIGIT}{{3}}[{IN_LINE_SPACES}]*-->[{IN_LINE_SPACES}]*"
    f"{_CLOCK}{DIGIT}{{3}}{_REST_OF_LINE}"
)
INLINE_TIMESTAMP = f"<{_CLOCK}{DIGIT}+>"
CAPTION_TAG = "</?c>"


def header_line(other_breaks: str) -> str:
    """Pattern of a header line; ``other_breaks`` are those that ``^`` does not see."""
    return (
        f"(?m)(?:^|[{other_breaks}])[{IN_LINE_SPACES}]*"
        f"(?:{'|'.join(HEADER_PREFIXES)}){_REST_OF_LINE}"
    )


_MARKUP = (
    CUE_RANGE,
    INLINE_TIMESTAMP,
    CAPTION_TAG,
    header_line(r"\x0b-\r\x1c-\x1e\x{85}\x{2028}\x{2029}"),
)

# Texts worked on together; bounds memory whatever the batch size.
_SLICE_BYTES = 1 << 20


def _find_repeats(codes: np.ndarray, text_end: np.ndarray, max_ngram: int):
    """Per word: phrase length and total words covered by a repeat starting there.

    Both are 0 where nothing repeats.  The longest phrase wins because longer
    lengths are written last.
    """
    phrase = np.zeros(len(codes), dtype=np.int32)
    covered = np.zeros(len(codes), dtype=np.int64)
    for n in range(1, min(max_ngram, len(codes) - 1) + 1):
        at = np.flatnonzero(codes[:-n] == codes[n:])
        at = at[at + n < text_end[at]]
        if not len(at):
            continue
        # Length of the unbroken run of equal pairs from each position on.
        last = np.append(np.flatnonzero(np.diff(at) != 1), len(at) - 1)
        run = at[np.repeat(last, np.diff(last, prepend=-1))] - at + 1
        long_enough = run >= n
        at, run = at[long_enough], run[long_enough]
        phrase[at] = n
        covered[at] = n * (run // n + 1)
    return phrase, covered


def _dropped_words(phrase: np.ndarray, covered: np.ndarray) -> np.ndarray:
    """Boolean mask of the words a left-to-right pass skips."""
    starts = np.flatnonzero(phrase)
    following = np.searchsorted(starts, starts + covered[starts]).tolist()
    taken, k = [], 0
    while k < len(following):
        taken.append(k)
        k = following[k]
    at = starts[taken]
    edge = np.zeros(len(phrase) + 1, dtype=np.int8)
    # Taken repeats never overlap, so each edge position is touched at most once per sign.
    edge[at + phrase[at]] += 1
    edge[at + covered[at]] -= 1
    return np.cumsum(edge[:-1], dtype=np.int8).astype(bool)


def _collapse_slice(texts: pa.Array, max_ngram: int) -> pa.Array:
    lists = pc.split_pattern(texts.cast(pa.large_string()), pattern=" ")
    lists = lists.cast(pa.large_list(pa.large_string()))
    offsets = lists.offsets.to_numpy()
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    if len(words) < 2:
        return texts
    codes = words.dictionary_encode().indices.to_numpy()
    text_end = np.repeat(offsets[1:], np.diff(offsets))
    phrase, covered = _find_repeats(codes, text_end, max_ngram)
    if not phrase.any():
        return texts
    keep = ~_dropped_words(phrase, covered)
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    kept = pa.LargeListArray.from_arrays(
        pa.array(kept_before[offsets]), words.filter(pa.array(keep)), mask=pc.is_null(texts)
    )
    return pc.binary_join(kept, pa.scalar(" ", pa.large_string())).cast(texts.type)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive texts of at most ``_SLICE_BYTES`` together, or one longer text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = before = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, before + _SLICE_BYTES, "right")))
        yield texts.slice(at, stop - at)
        at, before = stop, int(ends[stop - 1])


def _in_slices(texts: pa.Array, work: Callable[[pa.Array], pa.Array]) -> pa.Array:
    parts = [work(part) for part in _slices(texts)]
    return pa.concat_arrays(parts) if parts else texts


def slice_by_slice(
    arrays: Iterator[pa.Array], work: Callable[[pa.Array], pa.Array]
) -> Iterator[pa.Array]:
    """Results of ``work`` on a slice at a time, so that none is held for a whole batch."""
    for texts in arrays:
        yield from map(work, _slices(texts))
        # Not held while the next batch is read.
        del texts


def _rewritten(texts: pa.Array, rewrite) -> pa.Array:
    for pattern in _MARKUP:
        texts = pc.replace_substring_regex(texts, pattern, "")
    return pa.array([None if t is None else rewrite(t) for t in texts.to_pylist()], texts.type)


def _prose(text: str) -> str:
    text = " ".join(text.split())
    if "&" in text:
        text = html.unescape(text)
    return text.replace(">>", "\n>> ")


def _single_spaced_prose(text: str) -> str:
    return " ".join(_prose(text).split())


def collapse(texts: pa.Array, max_ngram: int = MAX_NGRAM) -> pa.Array:
    """Emit consecutive repeats of 1..max_ngram words once, in single-spaced texts."""
    return _in_slices(texts, lambda part: _collapse_slice(part, max_ngram))


def clean(texts: pa.Array) -> pa.Array:
    """Raw caption files to prose: markup out, entities decoded, speakers marked."""
    return _in_slices(texts, lambda part: _rewritten(part, _prose))


def finish(texts: pa.Array) -> pa.Array:
    """Raw caption files to single-spaced prose with repeated phrases collapsed."""
    return _in_slices(
        texts, lambda part: _collapse_slice(_rewritten(part, _single_spaced_prose), MAX_NGRAM)
    )


def _text_of(uri: str | None) -> str:
    if uri is None:
        return ""
    scheme, _, rest = uri.partition(":")
    system, path = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")
    with system.open_input_stream(path) as stream:
        text = stream.read().decode("utf-8", "replace")
    return text.replace("\r\n", "\n").replace("\r", "\n")


def with_texts(rows: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Batches with the text of the file that column ``at`` names as a last column."""
    for batch in rows:
        start, texts, size = 0, [], 0
        for end, uri in enumerate(batch.column(at).to_pylist(), 1):
            texts.append(_text_of(uri))
            size += len(texts[-1])
            if size >= _SLICE_BYTES or end == batch.num_rows:
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "raw_vtt"]
                )
                start, texts, size = end, [], 0
