"""Ranks without a global sort of wide rows: running ranks, and the smallest rows by selection."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.functions.arrays import int_div
from gridframe.operators.index import with_row_id


#: Bits of a key that one pass of a selection settles, and the lowest bigint.
_DIGIT, _LOWEST = 16, -(1 << 63)


def order_bits(value: Column) -> Column:
    """A bigint that orders as the double does; null and NaN come last, and both zeros are one."""
    number = value.cast("double") + F.lit(0.0)
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(number, F.lit(0.0))).cast("bigint")
    ordered = F.when(bits < 0, bits.bitwiseXOR(F.lit((1 << 63) - 1))).otherwise(bits)
    return F.when(value.isNull() | F.isnan(number), F.lit((1 << 63) - 1)).otherwise(ordered)


def among_smallest(df: DataFrame, keys: Sequence[Column], count: int) -> Column:
    """Whether a row is one of the ``count`` smallest by ``keys`` (bigint, not null), which together are unique.

    A selection, not a sort: rows are counted by the first 16 bits of the first key, then those of the one bucket that
    holds the boundary by the next 16, and so on, until a bucket is taken whole. A pass sends one row per bucket and
    task, and the driver sees at most 65,536 counts. ``df`` is read once a pass: give a stored one.
    """
    if count <= 0:
        return F.lit(False)
    below, tied = F.lit(False), F.lit(True)
    for key in keys:
        bits, head = key.bitwiseXOR(F.lit(_LOWEST)), 0
        for shift in range(64 - _DIGIT, -1, -_DIGIT):
            same = tied & (F.shiftrightunsigned(bits, shift + _DIGIT) == head) if shift + _DIGIT < 64 else tied
            digit = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << _DIGIT) - 1)).alias("digit")
            sizes = df.where(same).groupBy(digit).agg(F.count("*").alias("n")).collect()
            if shift + _DIGIT == 64 and sum(r["n"] for r in sizes) <= count:
                return below | tied
            for size in sorted(sizes):
                if count <= size["n"]:
                    break
                count -= size["n"]
            head = head << _DIGIT | size["digit"]
            limit = F.lit(head + _LOWEST) if shift == 0 else F.lit(head)
            up_to = key <= limit if shift == 0 else F.shiftrightunsigned(bits, shift) <= limit
            if count == size["n"]:
                return below | (tied & up_to)
        below, tied = below | (tied & (key < limit)), tied & (key == limit)
    raise ValueError("rows with equal keys cannot be told apart")


def smaller_before(values: np.ndarray) -> np.ndarray:
    """For every place the number of smaller values at earlier places, by doubling blocks."""
    n, place = len(values), np.arange(len(values))
    found, width = np.zeros(n, dtype="int64"), 1
    while width < n:
        pair, left = place // (2 * width), place // width % 2 == 0
        # Within a pair of blocks by value, the right block first among equals.
        order = np.lexsort((left, values, pair))
        passed = np.cumsum(left[order])
        before = np.searchsorted(pair, np.arange(pair[-1] + 1)) if n else place
        ahead = np.append(0, passed)[before][pair[order]]
        found[order] += np.where(left[order], 0, passed - ahead)
        width *= 2
    return found


def _counted(df: DataFrame, block: str, order: str, value: str, name: str) -> DataFrame:
    """Per block, in the order of ``order``: the number of earlier rows with a smaller ``value``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        return table.append_column(name, pa.array(smaller_before(table[value].to_numpy())))

    schema = T.StructType([*df.schema.fields, T.StructField(name, T.LongType())])
    return df.groupBy(block).applyInArrow(run, schema)


def running_rank(df: DataFrame, arrival: Sequence[str | Column], order: Sequence[str | Column], name: str = "rank", block: int | None = None) -> DataFrame:
    """``df`` with ``arrived``, the row's number by ``arrival`` from 1 on, and its rank by ``order`` among the rows that
    arrived no later. ``arrival`` is a total order; of equal rows in ``order`` the earlier ranks first.

    Rows are cut into blocks of consecutive arrivals and into blocks of consecutive ranks. The earlier and better rows of
    a row lie in its own arrival block (counted there), in earlier ones and its own rank block (counted there), or in
    earlier blocks of both, whose sizes are summed over a grid. A task holds one block of ``block`` rows; by default it
    grows with the root of their number, so that the grid stays a thousandth of them.
    """
    taken = with_row_id(with_row_id(df, arrival, "_a"), [*order, "_a"], "_m")
    if block is None:
        block = max(4096, 32 * int(np.ceil(np.sqrt(taken.count()))))
    cells = taken.withColumn("_ab", int_div(F.col("_a"), block)).withColumn("_mb", int_div(F.col("_m"), block))
    counts = cells.groupBy("_ab", "_mb").agg(F.count("*").alias("_n"))
    side = counts.agg((F.greatest(F.max("_ab"), F.max("_mb")) + 1).alias("s")).first()["s"] or 0
    grid = df.sparkSession.range(side * side).select(int_div(F.col("id"), max(side, 1)).alias("_ab"), (F.col("id") % max(side, 1)).alias("_mb"))
    grid = grid.join(counts, ["_ab", "_mb"], "left")
    below = lambda part, by, c: F.coalesce(F.sum(c).over(W.partitionBy(part).orderBy(by).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    grid = grid.withColumn("_row", below("_ab", "_mb", "_n")).withColumn("_grid", below("_mb", "_ab", "_row"))
    near = _counted(_counted(cells, "_ab", "_a", "_m", "_in_a"), "_mb", "_m", "_ab", "_in_m")
    ranked = near.join(grid.select("_ab", "_mb", "_grid"), ["_ab", "_mb"])
    rank = 1 + F.col("_in_a") + F.col("_in_m") + F.col("_grid")
    return ranked.select(*df.columns, (F.col("_a") + 1).alias("arrived"), rank.cast("long").alias(name))
