"""Row-by-row alignment of separately stored arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gridframe.sources.buckets import read_buckets


def zip_arrays(x: DataFrame, y: DataFrame, edge: DataFrame | None = None, on: Sequence[str] = ("column_id",)) -> DataFrame:
    """Row i of x with row i of y and of edge.

    An equi-join on the unique position; with the arrays in one container table (``write_container``) no join is
    needed at all.
    """
    zipped = x.join(y, list(on))
    return zipped.join(edge, list(on)) if edge is not None else zipped


def zip_buckets(spark: SparkSession, names: Sequence[str], on: Sequence[str] = ("column_id",)) -> DataFrame:
    """The same from tables stored by ``write_buckets`` with equal buckets: each task merges its bucket of every table,
    and no row is exchanged."""
    zipped = read_buckets(spark, names[0])
    for name in names[1:]:
        zipped = zipped.join(read_buckets(spark, name).hint("merge"), list(on))
    return zipped
