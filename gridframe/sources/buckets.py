"""Arrays stored in buckets of their position, so that joining them moves no row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gridframe.sources.shards import _writer


def write_buckets(df: DataFrame, name: str, path: str, buckets: int, on: Sequence[str] = ("column_id",), mode: str = "overwrite") -> None:
    """A table of the session's catalogue at ``path``, rows dealt into ``buckets`` files by a hash of ``on`` and sorted
    by it. The number of buckets is that of the tasks of a later join: about an executor's share of the data each."""
    laid_out = df.repartition(buckets, *on).sortWithinPartitions(*on)
    _writer(laid_out, mode).bucketBy(buckets, *on).sortBy(*on).option("path", path).saveAsTable(name)


def read_buckets(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def drop_buckets(spark: SparkSession, name: str) -> None:
    """Forget the table; its files stay where they were written."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
