"""Languages of a text by mixture inference over character n-grams.

Training counts hashed character trigrams per language over every labelled text.  A text
is then a mixture: expectation-maximisation finds the language proportions that make its
trigrams likeliest.  Languages enter the set one by one, in order of their share in the
full mixture, while the penalised likelihood (half a log of the text's independent
trigrams per language) improves.  The prediction is the largest share of the chosen set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from captide.llm.common import row_slices, share, shared, text_column

UNKNOWN = "und"
BINS = 1 << 15
SMOOTHING = 0.1
# Overlapping trigrams are not independent: three stand for one observation.
_OVERLAP = 3
_ROUNDS = 40
_TOLERANCE = 1e-3


def letter_bits() -> bytes:
    """One bit per code point: is it a letter."""
    return np.packbits([chr(i).isalpha() for i in range(0x110000)]).tobytes()


class Trigrams:
    """Hashed trigrams of a text's letters; other characters end a word."""

    def __init__(self, bits: bytes):
        self._letter = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)

    def of(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self._letter[points]
        if not letter.any():
            return np.empty(0, np.int64)
        padded = np.concatenate(([False], letter, [False]))
        points = np.concatenate(([0], np.where(letter, points, 0), [0])).astype(np.uint32)
        # One gap before and after each word is enough.
        points = points[padded | np.roll(padded, 1) | np.roll(padded, -1)]
        value = points[:-2] * np.uint32(0x9E3779B1)
        value = (value ^ points[1:-1]) * np.uint32(0x85EBCA6B)
        value = (value ^ points[2:]) * np.uint32(0xC2B2AE35)
        return ((value ^ value >> np.uint32(15)) % np.uint32(BINS)).astype(np.int64)


def _counted(bits: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigrams, counts = Trigrams(bits), {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = counts.setdefault(lang, np.zeros(BINS, np.int64))
                own += np.bincount(trigrams.of(text), minlength=BINS)
        for lang, own in counts.items():
            at = np.flatnonzero(own)
            yield pa.record_batch(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])],
                ["lang", "bin", "n"],
            )

    return run


class Profiles:
    """Log-probabilities of the trigram bins, one column per language."""

    def __init__(self, languages: list[str], log_share: np.ndarray):
        self.languages, self.log_share = languages, log_share

    def mixture(self, bins: np.ndarray, counts: np.ndarray, among: list[int]) -> tuple[np.ndarray, float]:
        """Proportions of the given languages in a text, and its log-likelihood under them."""
        logs = self.log_share[bins][:, among]
        top = logs.max(axis=1, keepdims=True)
        likelihood = np.exp(logs - top)
        total = counts.sum()
        share = np.full(len(among), 1 / len(among))
        for _ in range(_ROUNDS if len(among) > 1 else 0):
            joint = likelihood * share
            new = (counts / joint.sum(axis=1)) @ joint / total
            moved = np.abs(new - share).max()
            share = new
            if moved < _TOLERANCE:
                break
        fit = counts @ (np.log(likelihood @ share) + top[:, 0])
        return share, float(fit)

    def infer(self, trigrams: np.ndarray) -> list[tuple[str, float]]:
        """Languages of a text with their shares, largest first; empty without letters."""
        if not len(trigrams) or not self.languages:
            return []
        every = np.bincount(trigrams, minlength=BINS)
        bins = np.flatnonzero(every)
        counts = every[bins].astype(np.float64)
        share, _ = self.mixture(bins, counts, list(range(len(self.languages))))
        # Ties go to the language that is first in order of code points.
        order = np.argsort(-share, kind="stable").tolist()
        price = 0.5 * np.log(max(counts.sum() / _OVERLAP, 2.0))
        chosen, best = order[:1], None
        shares, fit = self.mixture(bins, counts, chosen)
        best = fit / _OVERLAP
        for k in order[1:]:
            wider, fit = self.mixture(bins, counts, [*chosen, k])
            if fit / _OVERLAP - price <= best:
                break
            chosen, shares, best = [*chosen, k], wider, fit / _OVERLAP - price
        ranked = sorted(zip(chosen, shares.tolist(), strict=True), key=lambda x: (-x[1], x[0]))
        return [(self.languages[k], s) for k, s in ranked]


def learn(labelled: DataFrame) -> Profiles:
    """Profiles from ``lang, text`` rows; rows without a language teach nothing.

    The driver receives at most ``BINS`` counts per language.
    """
    bits = letter_bits()
    counts = (
        labelled.where(F.col("lang").isNotNull())
        .select("lang", text_column().alias("text"))
        .mapInArrow(_counted(bits), "lang string, bin long, n long")
        .groupBy("lang", "bin")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names = counts["lang"].to_pylist()
    languages = sorted(set(names))
    place = {name: k for k, name in enumerate(languages)}
    table = np.full((BINS, len(languages)), SMOOTHING)
    table[counts["bin"].to_numpy(), [place[n] for n in names]] += counts["n"].to_numpy()
    return Profiles(languages, np.log(table / table.sum(axis=0)) if languages else table)


def predict(docs: DataFrame, profiles: Profiles, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``lang_pred, score`` and the language set with its shares.

    Only the text decides.  A null text, one without a letter, and any text when nothing
    was learned are ``und`` with score 0 and an empty set.  Repeated rows get equal
    results; an empty table gives an empty result; other columns are not read.
    """
    bits = letter_bits()
    model = share(docs.sparkSession, bits, profiles)
    source = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], text_column().alias("text"))
    at = len(keep)
    fields = [f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(source.schema.fields[:-1])]
    fields += ["lang_pred string", "score double", "languages array<string>", "shares array<double>"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, profiles = shared(model)
        trigrams = Trigrams(bits)
        for whole in batches:
            for batch in row_slices(whole, column=at):
                found = [profiles.infer(trigrams.of(t)) for t in batch.column(at).to_pylist()]
                yield pa.record_batch(
                    [
                        *batch.columns[:at],
                        pa.array([f[0][0] if f else UNKNOWN for f in found], pa.string()),
                        pa.array([min(1.0, f[0][1]) if f else 0.0 for f in found], pa.float64()),
                        pa.array([[x[0] for x in f] for f in found], pa.list_(pa.string())),
                        pa.array([[x[1] for x in f] for f in found], pa.list_(pa.float64())),
                    ],
                    names=[*batch.schema.names[:at], "lang_pred", "score", "languages", "shares"],
                )

    predicted = source.mapInArrow(run, ", ".join(fields))
    return predicted.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "lang_pred", "score", "languages", "shares"
    )
