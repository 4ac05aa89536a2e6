"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the mean of the vectors of its hashed character n-grams, a window of ``WINDOW``
words the mean of its words (absent ones as zero), and a softmax over that mean gives the
window's label.  The n-gram vectors and the softmax are trained together, in numpy, on a bounded sample.  A
misspelt word shares most n-grams with its model and so lands near it.  A document scores
as its worst window, so a long text does not dilute a short outburst; training sees a
document the same way, with all its windows.  Both labels weigh the same in training, so a
score is a probability as if they were equally common.

Because averaging and the linear layer commute, a trained model gives each word one number
and a window's logit is the mean over its words: scoring is one pass over whole texts.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.llm.common import row_slices, share, shared, text_column

BUCKETS = 1 << 17
DIMENSIONS = 8
NGRAMS = (3, 4, 5, 6)
WINDOW = 32
# Scored windows overlap by half, so that a passage on the edge of one is inside another.
HALF = WINDOW // 2
# Bounds of the training sample: documents per label.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2000, 6000
# Words whose n-grams are made together.
_WORDS_AT_ONCE = 20_000
_STEPS, _WARM_UP = 60, 20
_RATE, _MOMENTUM, _DECAY, _OUTPUT_RATE = 1.0, 0.9, 0.02, 0.05
_DOCUMENTS_AT_ONCE = 200
# Weight of the prior against an n-gram, in documents.
PRIOR_DOCUMENTS = 10
_CACHE_WORDS = 300_000
_WORDS = re.compile(r"[^\W_]+").findall


def words_of(text: str) -> list[str]:
    return _WORDS(text.lower())


@dataclass(frozen=True)
class Windows:
    """Windows of many texts as bags of distinct words: a word repeated all over counts once in each.

    ``word`` and ``window`` are parallel: a word's number and the window it is in.
    ``first`` is each text's first window; a text without a word has one empty window.
    """

    word: np.ndarray
    window: np.ndarray
    first: np.ndarray
    count: int

    @classmethod
    def apart(cls, codes: np.ndarray, lengths: np.ndarray) -> Windows:
        """Windows side by side, which hold each word of a text once: those that training uses."""
        place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        counts = np.maximum(1, -(-lengths // WINDOW))
        first = np.cumsum(counts) - counts
        span = int(codes.max(initial=0)) + 1
        bags = np.unique((np.repeat(first, lengths) + place // WINDOW) * span + codes)
        return cls(bags % span, (bags // span).astype(np.int32), first, int(counts.sum()))

    @classmethod
    def of(cls, codes: np.ndarray, lengths: np.ndarray) -> Windows:
        """Windows that overlap by half, from the word numbers of all texts and the texts' lengths."""
        text = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        # Where in its text a word stood before, or -1.
        key = text * (int(codes.max(initial=0)) + 1) + codes
        order = np.argsort(key, kind="stable")
        again = key[order[1:]] == key[order[:-1]]
        before = np.full(len(codes), -1)
        before[order[1:][again]] = place[order[:-1][again]]
        counts = np.maximum(1, -(-lengths // HALF) - 1)
        first = np.cumsum(counts) - counts
        # A window is two halves; a word counts in it if it did not stand in it before.
        half = place // HALF
        own = (before < half * HALF) & (half < counts[text])
        last = (before < (half - 1) * HALF) & (half > 0)
        return cls(
            np.concatenate((codes[own], codes[last])),
            np.concatenate(((first[text] + half)[own], (first[text] + half - 1)[last])).astype(np.int32),
            first,
            int(counts.sum()),
        )


def ngrams_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``word_ngrams`` of many words, some at a time."""
    parts = [word_ngrams(words[at : at + _WORDS_AT_ONCE]) for at in range(0, len(words), _WORDS_AT_ONCE)]
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def word_ngrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words, with marks at both ends, and the words themselves.

    Also gives each word's number of them.
    """
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(w) + 2 for w in words])
    ends = np.repeat(np.cumsum(lengths), lengths)
    found, owner = [], []
    word = np.repeat(np.arange(len(words)), lengths)
    for n in NGRAMS:
        inside = np.flatnonzero(np.arange(len(points)) + n <= ends)
        value = np.full(len(inside), n, np.uint32)
        for k in range(n):
            value = (value ^ points[inside + k]) * np.uint32(0x01000193)
            value ^= value >> np.uint32(13)
        found.append(value * np.uint32(0x9E3779B1) ^ value >> np.uint32(15))
        owner.append(word[inside])
    # The word as a whole, in buckets like the n-grams.
    found.append(np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words], np.uint32))
    owner.append(np.arange(len(words)))
    owner, found = np.concatenate(owner), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    return (found[order] % np.uint32(BUCKETS)).astype(np.int32), np.bincount(owner, minlength=len(words))


class Model:
    """Trained n-gram vectors and softmax, as one number per n-gram and a bias."""

    def __init__(self, ngram_logits: np.ndarray, bias: float):
        self.ngram_logits, self.bias = ngram_logits, bias

    def word_logits(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.empty(0)
        grams, counts = word_ngrams(words)
        starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
        return np.add.reduceat(self.ngram_logits[grams], starts) / counts


class Scorer:
    """Scores texts, remembering a bounded number of words."""

    def __init__(self, model: Model):
        self._model, self._known = model, {}

    def learn_words(self, words: Iterable[str]) -> None:
        if len(self._known) > _CACHE_WORDS:
            self._known.clear()
        new = [w for w in words if w not in self._known]
        self._known.update(zip(new, self._model.word_logits(new).tolist(), strict=True))

    def score_all(self, texts: list[str]) -> np.ndarray:
        """Scores of texts: of each the worst window's probability."""
        split = [words_of(t) for t in texts]
        numbers: dict[str, int] = {}
        codes = np.array([numbers.setdefault(w, len(numbers)) for words in split for w in words], np.int64)
        self.learn_words(numbers)
        value = np.array([self._known[w] for w in numbers])
        windows = Windows.of(codes, np.array([len(words) for words in split], np.int64))
        sums = np.bincount(windows.window, value[windows.word] if len(value) else None, windows.count)
        worst = np.maximum.reduceat(sums, windows.first) / WINDOW if len(texts) else np.empty(0)
        return 1 / (1 + np.exp(-np.clip(worst + self._model.bias, -60, 60)))


def _document_counts(
    words: np.ndarray, document: np.ndarray, grams: np.ndarray, gram_word: np.ndarray, n_words: int
) -> np.ndarray:
    """In how many documents each bucket's n-grams occur; copies within one count once."""
    pairs = np.unique(document.astype(np.int64) * n_words + words)
    word, at = pairs % n_words, pairs // n_words
    starts = np.searchsorted(gram_word, np.arange(n_words + 1))
    counts = np.zeros(BUCKETS, np.int64)
    # Some documents at a time; a document's pairs stay together.
    cuts = np.flatnonzero(np.diff(at, prepend=-1))[::_DOCUMENTS_AT_ONCE].tolist()
    for low, high in zip(cuts, [*cuts[1:], len(pairs)], strict=True):
        sizes = np.diff(starts)[word[low:high]]
        first = starts[word[low:high]] - np.concatenate(([0], np.cumsum(sizes)[:-1]))
        bucket = grams[np.repeat(first, sizes) + np.arange(sizes.sum())]
        once = np.unique(np.repeat(at[low:high], sizes) * BUCKETS + bucket)
        counts += np.bincount(once % BUCKETS, minlength=BUCKETS)
    return counts


def train(
    vocabulary: list[str], windows: Windows, document: np.ndarray, labels: np.ndarray, seed: int = 5
) -> Model:
    """Joint gradient descent on the n-gram vectors and the softmax.

    ``document`` gives each window's document, ``labels`` each document's label.  After a
    warm-up on all windows, a toxic document learns from its worst window, a clean one
    from its worst and, with half the weight, all others.  With two labels the gradient of a
    vector lies along the difference of the output rows; it is scaled by the n-gram's curvature.
    """
    words, owner = windows.word.astype(np.int32), windows.window
    grams, gram_counts = ngrams_of(vocabulary)
    gram_word = np.repeat(np.arange(len(vocabulary), dtype=np.int32), gram_counts)
    starts = np.cumsum(gram_counts) - gram_counts
    per_document = np.bincount(document, minlength=len(labels)).astype(float)
    window_label = labels[document]
    # An n-gram's evidence: in how many documents it is, and its usual share of a window.
    documents = _document_counts(words, document[owner], grams, gram_word, len(vocabulary))
    times = np.bincount(words, minlength=len(vocabulary)).astype(float)
    share = np.bincount(grams, (times / WINDOW / gram_counts)[gram_word], BUCKETS)
    usual = share / np.maximum(np.bincount(grams, times[gram_word], BUCKETS), 1)
    # All n-grams of a window move at once; as their shares add up to one at most, a share,
    # not its square, bounds how the loss bends along each of them.
    curvature = np.maximum((documents + PRIOR_DOCUMENTS) * usual / 4, 1e-30)
    shrink = PRIOR_DOCUMENTS / (documents + PRIOR_DOCUMENTS)

    random = np.random.default_rng(seed)
    vectors = random.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    # Two output rows and their biases; clean is row 0.
    output, bias = random.normal(0, 0.3, (2, DIMENSIONS)), np.zeros(2)
    moved = np.zeros_like(vectors)
    # Both labels weigh the same, however many documents have them.
    balance = len(labels) / 2 / np.maximum(np.bincount(labels, minlength=2), 1)

    for step in range(1, _STEPS + 1):
        contrast = output[1] - output[0]
        by_gram = (vectors @ contrast).astype(np.float32)
        by_word = np.add.reduceat(by_gram[grams], starts) / gram_counts
        logit = np.bincount(owner, by_word[words], windows.count) / WINDOW + bias[1] - bias[0]
        toxic = 1 / (1 + np.exp(-np.clip(logit, -60, 60)))
        weight = 1 / per_document[document]
        if step > _WARM_UP:
            order = np.lexsort((logit, document))
            last = np.flatnonzero(np.append(np.diff(document[order]) != 0, True))
            worst = np.zeros(windows.count, bool)
            worst[order[last]] = True
            weight = np.where(worst, 1.0, np.where(window_label == 1, 0.0, weight))
        weight = weight * balance[window_label]
        # Softmax over two labels: the errors of the rows are opposite.
        error = (toxic - window_label) * weight
        by_word = np.bincount(words, (error / WINDOW)[owner], len(vocabulary)) / gram_counts
        gradient = np.bincount(grams, by_word[gram_word], BUCKETS)
        # Each n-gram moves by its gradient over its curvature, with a prior of documents
        # that speak for zero, so those of a few texts cannot be memorised.
        towards = gradient @ vectors / weight.sum()
        scaled = np.outer(gradient / curvature, contrast / (contrast @ contrast))
        moved = _MOMENTUM * moved + scaled + _DECAY * shrink[:, None] * vectors
        vectors -= _RATE * moved
        output -= _OUTPUT_RATE * np.stack([-towards, towards])
        bias -= np.array([-1.0, 1.0]) * error.sum() / weight.sum()
    return Model(vectors @ (output[1] - output[0]), float(bias[1] - bias[0]))


def learn(docs: DataFrame, labels: DataFrame, seed: int = 5) -> Model:
    """A model from ``doc_id, text`` and ``doc_id, toxic``.

    The sample is bounded in rows by its two constants and taken by a hash of the id; of
    its rows the whole text teaches.  Null labels teach nothing, nor do
    ids with both labels.  Without examples of both labels the model scores everything 0.5
    or below.
    """
    known = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("other"))
        .where("toxic = other")
        .drop("other")
    )
    mark = F.xxhash64("doc_id", F.lit(seed))
    sample = (
        known.where("toxic = 1").orderBy(mark, "doc_id").limit(SAMPLE_TOXIC)
        .union(known.where("toxic = 0").orderBy(mark, "doc_id").limit(SAMPLE_CLEAN))
    )
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
        .join(sample, "doc_id")
        .select("doc_id", "toxic", "text")
        .orderBy("doc_id", "text")
        .toArrow()
    )
    ids, text_document = np.unique(rows["doc_id"].to_numpy(), return_inverse=True)
    labels_found = np.zeros(len(ids), np.int64)
    labels_found[text_document] = rows["toxic"].to_numpy()
    if len(set(labels_found.tolist())) < 2:
        return Model(np.zeros(BUCKETS), -1.0)
    numbers: dict[str, int] = {}
    codes, lengths = array("i"), []
    # One text at a time, so that only distinct words are held as strings.
    for text in rows["text"]:
        found = [numbers.setdefault(w, len(numbers)) for w in words_of(text.as_py())]
        codes.extend(found)
        lengths.append(len(found))
    windows = Windows.apart(np.frombuffer(codes, np.int32).astype(np.int64), np.array(lengths, np.int64))
    if not numbers:
        return Model(np.zeros(BUCKETS), -1.0)
    document = np.repeat(text_document, np.diff(np.append(windows.first, windows.count)))
    return train(list(numbers), windows, document, labels_found, seed)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted`` for every whole text.

    A null or empty text, or one without a word, has the score of the bias alone.  Only
    the text is read.  Repeated rows get equal scores; an empty table gives an empty
    result.
    """
    trained = share(docs.sparkSession, model)
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], text_column().alias("text"))
    at = len(keep)
    fields = [f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(source.schema.fields[:-1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared(trained))
        for whole in batches:
            for batch in row_slices(whole, column=at):
                scores = pa.array(scorer.score_all(batch.column(at).to_pylist()), pa.float64())
                yield pa.record_batch([*batch.columns[:at], scores], names=[*batch.schema.names[:at], "score"])

    scored = source.mapInArrow(run, ", ".join([*fields, "score double"]))
    return scored.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
