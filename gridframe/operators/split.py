"""Exact random splits.

Membership is decided by comparing a row's hash key with the key at each boundary, so the split itself is a projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.functions.draws import hash_key
from gridframe.operators.index import hash_order_cuts


def _label(df: DataFrame, row_id: str, seed, bounds: dict, name: str) -> DataFrame:
    cuts = hash_order_cuts(df, row_id, seed, bounds).select(F.struct(*bounds).alias("c")).scalar()
    key = hash_key(row_id, seed)
    # A bound equal to the row count has no row standing at it: everything lies below.
    below = {k: F.coalesce(key < F.col("_cuts")[k], F.lit(True)) for k in bounds}
    label = F.when(below["val"], "train").when(below["test"], "val").otherwise("test")
    return df.withColumn("_cuts", cuts).withColumn(name, label).drop("_cuts")


def random_split(
    df: DataFrame, row_id: str, seed, train: float = 0.8, val: float = 0.1, name: str = "split"
) -> DataFrame:
    """floor(train * n) training rows, floor(val * n) validation rows, the remainder for testing."""
    n = F.col("_total")
    first = F.floor(n * F.lit(float(train)))
    second = first + F.floor(n * F.lit(float(val)))
    return _label(df, row_id, seed, {"val": first, "test": second}, name)


def shuffled_slices(
    df: DataFrame, row_id: str, seed, first: float = 0.8, second: float = 0.9, name: str = "split"
) -> DataFrame:
    """Shuffled order cut at floor(first * n) and floor(second * n)."""
    n = F.col("_total")
    bounds = {"val": F.floor(n * F.lit(float(first))), "test": F.floor(n * F.lit(float(second)))}
    return _label(df, row_id, seed, bounds, name)
