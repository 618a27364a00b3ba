"""Applying stored statistics to every record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.functions.arrays import let
from gridframe.operators.moments import stats_record
from gridframe.operators.reshape import array_rank

# Fixed value: keeps a position without spread from dividing by zero.
EPSILON = 1e-8


def attach_stats(df: DataFrame, stats: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """``{array}_mean`` and ``{array}_std`` on every row.

    The one-row record is a scalar subquery: as long as one array, computed once, joined to nothing.
    """
    names = [f"{a}_{k}" for a in arrays for k in ("mean", "std")]
    record = stats_record(stats, arrays).select(F.struct(*names))
    return df.withColumn("_stats", record.scalar()).select(*df.columns, *[F.col("_stats")[n].alias(n) for n in names])


def normalize(df: DataFrame, array: str, stats: DataFrame, epsilon: float = EPSILON, name: str | None = None) -> DataFrame:
    """(x - mean) / (std + epsilon) per position of a vector, or of a matrix with row-major statistics.

    A record that is not as long as the statistics, or whose rows differ in width, fails the job; a missing record stays
    missing.
    """
    mean, std = F.col(f"{array}_mean"), F.col(f"{array}_std")
    attached = attach_stats(df, stats, [array])
    if array_rank(df, array) == 1:
        centred = F.zip_with(array, mean, lambda v, m: v - m)
        scaled = F.zip_with(centred, std, lambda v, s: v / (s + F.lit(epsilon)))
    else:

        def cells(m: Column, s: Column, row: Column, i: Column) -> Column:
            start, width = i * F.size(row) + 1, F.size(row)
            centred = F.zip_with(row, F.slice(m, start, width), lambda v, c: v - c)
            return F.zip_with(centred, F.slice(s, start, width), lambda v, d: v / (d + F.lit(epsilon)))

        scaled = let(mean, lambda m: let(std, lambda s: F.transform(array, lambda row, i: cells(m, s, row, i))))
    values = F.col(array)
    fits = F.size(values) == F.size(mean)
    if array_rank(df, array) > 1:
        fits = (F.size(F.flatten(values)) == F.size(mean)) & F.forall(values, lambda row: F.size(row) * F.size(values) == F.size(mean))
    wrong = F.raise_error(F.lit(f"{array} is not as long as its statistics"))
    scaled = F.when(values.isNull() | F.coalesce(fits, F.lit(False)), scaled).otherwise(wrong)
    return attached.withColumn(name or array, scaled).drop(f"{array}_mean", f"{array}_std")
