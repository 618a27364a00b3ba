"""Array expressions: every function maps columns of one record to one column.

An expression used inside a lambda is evaluated again for every element, and the optimiser moves derived columns into
lambdas. Arrays are therefore passed as arguments of the outer function, or bound once with ``let``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once per record."""
    return F.get(F.transform(F.array(_col(value)), lambda v: body(v)), F.lit(0))


def int_div(value, by) -> Column:
    """Integer quotient, exact for the whole range of bigint."""
    return F.call_function("div", _col(value), F.lit(by))


def flatten_row(matrix) -> Column:
    """Row-major vector of a levels x variables matrix."""
    return F.flatten(_col(matrix))


def concat_features(*vectors) -> Column:
    """Vectors joined end to end in the given order."""
    return F.concat(*[_col(v) for v in vectors])


def add_axis(vector) -> Column:
    """Each scalar of a vector as a vector of length one."""
    return F.transform(_col(vector), lambda v: F.array(v))


def broadcast_to_levels(vector, levels) -> Column:
    """The record's vector repeated on every level."""
    return F.array_repeat(_col(vector), levels)


def pad_levels(matrix, top: int = 1, bottom: int = 1, width: int | None = None, dtype: str = "float") -> Column:
    """Zero rows added above and below; ``width`` is only needed where a record may have no rows at all."""
    matrix = _col(matrix)
    cells = F.lit(width) if width is not None else F.size(matrix[0])
    zeros = F.array_repeat(F.lit(0).cast(dtype), cells)
    return F.concat(F.array_repeat(zeros, top), matrix, F.array_repeat(zeros, bottom))


def node_features(half_level, inter, scalars, dtype: str = "float") -> Column:
    """Per node: half-level variables, padded interface variables, then the record's scalars."""
    half_level = _col(half_level)
    per_level = F.zip_with(half_level, pad_levels(inter, dtype=dtype), lambda a, b: F.concat(a, b))
    return F.zip_with(per_level, broadcast_to_levels(scalars, F.size(half_level)), lambda a, b: F.concat(a, b))


def node_targets(first, *others) -> Column:
    """Per node: one value of each profile; profiles of different length fail the job."""
    profiles = [_col(p) for p in (first, *others)]
    same = F.lit(True)
    for other in profiles[1:]:
        same = same & (F.size(other) == F.size(profiles[0]))
    names = [f"p{i}" for i in range(len(profiles))]
    zipped = F.arrays_zip(*[p.alias(n) for p, n in zip(profiles, names)])
    rows = F.transform(zipped, lambda r: F.array(*[r[n] for n in names]))
    return F.when(same, rows).otherwise(F.raise_error(F.lit("profiles differ in length")))


def zip_equal(**arrays) -> Column:
    """Arrays of equal length as one array of structs; others, or missing ones, fail the job."""
    first, *others = [_col(a) for a in arrays.values()]
    same = F.size(first) >= 0
    for other in others:
        same = same & (F.size(other) == F.size(first))
    zipped = F.arrays_zip(*[_col(a).alias(n) for n, a in arrays.items()])
    return F.when(same, zipped).otherwise(F.raise_error(F.lit(f"{' and '.join(arrays)} differ in length or are missing")))


def take_variable(matrix, index: int) -> Column:
    """One variable over all levels."""
    return F.transform(_col(matrix), lambda row: row[index])


def squeeze(matrix) -> Column:
    """Drop an inner or outer axis of length one."""
    return F.flatten(_col(matrix))


def reshape_row(vector, rows: int, width: int) -> Column:
    """A vector of rows * width values as a rows x width matrix."""
    starts = F.sequence(F.lit(1), F.lit((rows - 1) * width + 1), F.lit(width))
    return let(vector, lambda v: F.transform(starts, lambda at: F.slice(v, at, F.lit(width))))


def cast_to(array, element_type: str, rank: int = 1) -> Column:
    """Element type changed, shape kept."""
    for _ in range(rank):
        element_type = f"array<{element_type}>"
    return _col(array).cast(element_type)


def level_diff(vector) -> Column:
    """Value minus the value one level above; one element shorter."""

    def steps(v: Column) -> Column:
        n = F.size(v) - 1
        return F.zip_with(F.slice(v, F.lit(2), n), F.slice(v, F.lit(1), n), lambda low, high: low - high)

    return let(vector, steps)


def to_unit_per_day(rate) -> Column:
    """Rates per second as rates per day."""
    return F.transform(_col(rate), lambda v: v * F.lit(86400.0))
