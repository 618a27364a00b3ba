"""Sums without rounding: the same bits for any number and order of partitions.

A double is a whole number times a power of two. It is cut into limbs of 32 bits that stand at fixed powers, and limbs
are added as integers, which no order changes. A square is cut into three products that doubles hold exactly. The one
rounding comes at the end, when the limbs of a sum are read as one number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction
from math import inf, nan, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.operators.reshape import as_vector

#: Bits of a limb, the power of two of the lowest one (below any square of a double), and the number of places.
LIMB, LOWEST, PLACES = 32, -2176, 144
#: Values of a position added before carries are passed on: far fewer than the 2 ** 31 limbs a bigint holds for certain.
_ROWS = 1 << 20

_LIMBS = "array int, pos int, kind int, place int, limb bigint"
_SUM, _SQUARE, _COUNT, _NAN, _PLUS, _MINUS = range(6)


def cut_up(fraction: np.ndarray, exponent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and limbs, three for each ``fraction * 2 ** exponent`` (as ``frexp`` gives them), that sum to it."""
    whole = np.abs(np.ldexp(fraction, 53)).astype("uint64")
    power = exponent.astype("int64") - 53 - LOWEST
    place, shift = power // LIMB, (power % LIMB).astype("uint64")
    mask = np.uint64(0xFFFFFFFF)
    low = (whole & mask) << shift
    high = ((whole >> np.uint64(32)) << shift) + (low >> np.uint64(32))
    parts = np.stack([low & mask, high & mask, high >> np.uint64(32)], axis=-1).astype("int64")
    return place[:, None] + np.arange(3), np.where(fraction[:, None] < 0, -parts, parts)


def squared(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Fractions and exponents of three numbers that sum to each square, however large or small the value is."""
    fraction, exponent = np.frexp(values)
    wide = fraction * 134217729.0
    high = wide - (wide - fraction)
    low = fraction - high
    parts = [np.frexp(p) for p in (high * high, 2.0 * high * low, low * low)]
    return [(f, e + 2 * exponent) for f, e in parts]


def _carried(totals: np.ndarray) -> np.ndarray:
    """The same numbers with limbs of 32 bits; the last place keeps the sign and what is beyond."""
    for place in range(totals.shape[-1] - 1):
        carry = totals[..., place] >> LIMB
        totals[..., place] -= carry << LIMB
        totals[..., place + 1] += carry
    return totals


class Sums:
    """Limbs of sums and squares, and counts, of the positions of one array."""

    def __init__(self) -> None:
        self.totals = np.zeros((0, 2, PLACES), dtype="int64")
        self.counts = np.zeros((0, 4), dtype="int64")
        self.added = 0

    def add(self, pos: np.ndarray, values: np.ndarray) -> None:
        most = int(pos.max()) + 1 if len(pos) else 0
        if most > len(self.counts):
            more = most - len(self.counts)
            self.totals = np.concatenate([self.totals, np.zeros((more, 2, PLACES), dtype="int64")])
            self.counts = np.concatenate([self.counts, np.zeros((more, 4), dtype="int64")])
        for kind, flags in enumerate((np.ones(len(pos), dtype=bool), np.isnan(values), values == inf, values == -inf)):
            self.counts[:, kind] += np.bincount(pos[flags], minlength=len(self.counts))
        finite = np.isfinite(values)
        pos, values = pos[finite], values[finite]
        for kind, parts in ((_SUM, [np.frexp(values)]), (_SQUARE, squared(values))):
            for fraction, exponent in parts:
                place, limb = cut_up(fraction, exponent)
                np.add.at(self.totals, (pos[:, None], kind, place), limb)
        self.added += len(pos)
        if self.added >= _ROWS:
            self.totals, self.added = _carried(self.totals), 0

    def rows(self, array: int) -> pa.RecordBatch:
        self.totals = _carried(self.totals)
        pos, kind, place = np.nonzero(self.totals)
        found = [(pos, kind, place, self.totals[pos, kind, place])]
        at, which = np.nonzero(self.counts)
        found.append((at, which + _COUNT, np.zeros(len(at), dtype="int64"), self.counts[at, which]))
        pos, kind, place, limb = map(np.concatenate, zip(*found))
        arrays = [pa.array(np.full(len(pos), array), pa.int32()), *[pa.array(c, pa.int32()) for c in (pos, kind, place)], pa.array(limb)]
        return pa.RecordBatch.from_arrays(arrays, names=["array", "pos", "kind", "place", "limb"])


def exact_moments(df: DataFrame, arrays: Sequence[str], unit: int = 0) -> DataFrame:
    """(array, pos, n, sum, mean, std, units): moments of every array position, each rounded once from its exact value.

    ``units`` is the sum in units of ``2 ** unit`` as text, null where that is no whole number. Null elements do not count;
    a NaN, or infinities of both signs, make sum, mean and deviation NaN, an infinity of one sign makes the sum and mean
    infinite. Stored results can be compared bit by bit however the rows lay. A task sends a few limbs per position.
    """

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [Sums() for _ in arrays]
        for batch in batches:
            for number, column in enumerate(batch.columns):
                lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                first = np.cumsum(lengths) - lengths
                pos = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
                flat = column.flatten()
                there = flat.is_valid().to_numpy(zero_copy_only=False)
                values = flat.to_numpy(zero_copy_only=False).astype("f8")
                for start in range(0, len(pos), _ROWS):
                    some = slice(start, start + _ROWS)
                    sums[number].add(pos[some][there[some]], values[some][there[some]])
        for number, total in enumerate(sums):
            if len(total.counts):
                yield total.rows(number)

    def rounded(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = {k: 0 for k in range(6)}
        for kind, place, limb in zip(*(table[c].to_pylist() for c in ("kind", "place", "limb"))):
            parts[kind] += limb << (LIMB * place)
        n, one = parts[_COUNT], Fraction(1, 1 << -LOWEST)
        total, square = parts[_SUM] * one, parts[_SQUARE] * one
        special = nan if parts[_NAN] or (parts[_PLUS] and parts[_MINUS]) else inf if parts[_PLUS] else -inf if parts[_MINUS] else None
        units = total / Fraction(2) ** unit
        if special is None:
            variance = (square - total * total / n) / n
            row = [_float(total), _float(total / n), sqrt(_float(variance)), str(units.numerator) if units.denominator == 1 else None]
        else:
            row = [special, special, nan, None]
        cells = [[arrays[key[0].as_py()]], [key[1].as_py()], [n], *[[v] for v in row]]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.string()]
        return pa.table([pa.array(c, k) for c, k in zip(cells, kinds)], names=["array", "pos", "n", "sum", "mean", "std", "units"])

    vectors = df.select(*[as_vector(df, name).alias(f"_{i}") for i, name in enumerate(arrays)])
    total = vectors.mapInArrow(gathered, _LIMBS).groupBy("array", "pos", "kind", "place").agg(F.sum("limb").alias("limb"))
    schema = "array string, pos int, n bigint, sum double, mean double, std double, units string"
    return total.groupBy("array", "pos").applyInArrow(rounded, schema)


def _float(value: Fraction) -> float:
    """The nearest double, infinite beyond the range."""
    try:
        return float(value)
    except OverflowError:
        return inf if value > 0 else -inf
