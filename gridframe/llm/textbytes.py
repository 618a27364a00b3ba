"""Words, hashes and digests of Arrow text columns, computed over their UTF-8 bytes with NumPy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Bytes that separate words: space and 0x09 to 0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, other bytes unchanged.
ASCII_LOWER = np.arange(256, dtype="uint8")
ASCII_LOWER[0x41:0x5B] += 0x20

_SEED = 20240229
BYTE_VALUES = np.random.default_rng(_SEED).integers(1, 2**63, 256, dtype="uint64") * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def added(df: DataFrame, **columns: str) -> T.StructType:
    """The schema of a frame with further columns, given by name and type."""
    return T.StructType([*df.schema.fields, *[T.StructField(n, T._parse_datatype_string(t)) for n, t in columns.items()]])


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand whole texts to Python in Arrow batches of some megabytes: ten thousand rows a batch, the default, would
    take several times a batch's text in each task. A setting of the session, for programs to make."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype("uint64", copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(max(n, 1), base, dtype="uint64")
    out[0] = 1
    return np.multiply.accumulate(out)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the row offsets into them; nulls are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype="int64")[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype="uint8") if data is not None and data.size else np.zeros(0, dtype="uint8")
    return whole[offsets[0] : offsets[-1]] if len(column) else whole[:0], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, text: str = "text", most_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``most_bytes`` of text, so that memory follows one slice."""
    _, offsets = raw(batch.column(text))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most_bytes, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """The words of a slice of texts: byte spans, 64-bit hashes, and the first word of each text."""

    def __init__(self, column: pa.Array, separators: np.ndarray = SPACE, fold: np.ndarray | None = None):
        data, self.offsets = raw(column)
        self.data = data if fold is None else fold[data]
        n = len(self.data)
        inside = ~separators[self.data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        at = self.offsets[:-1][self.offsets[:-1] < n]
        first[at] = inside[at]
        self.starts = np.flatnonzero(first)
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        ends = self.offsets[1:][self.offsets[1:] > 0] - 1
        last[ends] = inside[ends]
        self.ends = np.flatnonzero(last) + 1
        self.of_text = np.searchsorted(self.starts, self.offsets)
        self.inside = inside

    def __len__(self) -> int:
        return len(self.starts)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of_text) - 1), np.diff(self.of_text))

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """Hash of each word, or of its first ``prefix`` bytes."""
        if not len(self.starts):
            return np.zeros(0, dtype="uint64")
        sizes = self.ends - self.starts
        if prefix is not None:
            sizes = np.minimum(sizes, prefix)
        before = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(before, sizes)
        value = BYTE_VALUES[self.data[np.repeat(self.starts, sizes) + place]] * powers(int(sizes.max()))[place]
        return mix(np.add.reduceat(value, before) + sizes.astype("uint64"))


def window_hashes(words: np.ndarray, size: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes; one value per start, ``len(words) - size + 1`` of them."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype="uint64")
    total = np.zeros(n, dtype="uint64")
    for i, factor in enumerate(powers(size, np.uint64(base))):
        total += words[i : i + n] * factor
    return mix(total)
