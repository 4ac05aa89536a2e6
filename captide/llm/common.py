"""Helpers the operators share: input columns, words, hashes, written intermediates."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from captide.sources.staging import stage  # noqa: F401

# White space that ends a word, as a character class body.
BLANKS = r"\x20\x09-\x0D"

# Text worked on together inside a task; bounds memory whatever the batch size.
_SLICE_BYTES = 8 << 20
# Remembered words per task.
_CACHE_WORDS = 400_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def text_column(name: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns named by place, ``c0`` on, so that no added name clashes.

    ``DataFrame.toDF(*docs.columns)`` of these columns gives the names back.
    """
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def column_place(docs: DataFrame, name: str) -> str:
    """The name that ``numbered`` gives a column."""
    return f"c{docs.columns.index(name)}"


def share(spark: SparkSession, *values: object) -> Broadcast:
    """Broadcast values that may hold classes of this package; read with ``shared``.

    A plain broadcast would need the package on the executors.
    """
    return spark.sparkContext.broadcast(cloudpickle.dumps(values))


def shared(values: Broadcast) -> tuple:
    return pickle.loads(values.value)


def crc_fold(id_column: str, folds: int) -> Column:
    """Remainder of the CRC-32 of an id written as text; null for a null id."""
    return F.pmod(F.crc32(F.col(id_column).cast("string")), F.lit(folds))


def row_slices(
    batch: pa.RecordBatch, column: int = 1, most: int = _SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """A batch in parts of bounded text size."""
    size = max(1, batch.column(column).nbytes)
    rows = max(1, batch.num_rows * most // size)
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def lowered_words(text: str) -> list[bytes]:
    """Words of a text with A-Z lower-cased.

    For bytes, Python lowers only A-Z and splits at exactly the six blanks.
    """
    return text.encode().lower().split()


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > _CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer on 64-bit words (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
