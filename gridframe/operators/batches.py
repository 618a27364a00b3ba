"""Mini-batches as a column: integer arithmetic on a dense position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.functions.arrays import int_div
from gridframe.functions.permute import permuted
from gridframe.operators.index import shuffle_rows


def batch_of(position: str, size: int) -> Column:
    return int_div(F.col(position), size)


def batches(df: DataFrame, position: str, size: int, shuffle: bool = False, seed=None) -> DataFrame:
    """``batch_id`` of consecutive rows; with ``shuffle`` of rows in the random order of the seed. The last batch
    may be short."""
    if shuffle:
        df = shuffle_rows(df, position, seed, "shuffled")
        return df.withColumn("batch_id", batch_of("shuffled", size))
    return df.withColumn("batch_id", batch_of(position, size))


def epoch_batches(df: DataFrame, position: str, size: int, seed, epoch: int, n: int | None = None) -> DataFrame:
    """``shuffled`` and ``batch_id`` of an epoch: every epoch has an order of its own, and every row its place in it by
    arithmetic on the dense ``position``. Rows are neither sorted nor moved. ``n`` is their number, counted if not given.
    """
    n = df.count() if n is None else n
    return df.withColumn("shuffled", permuted(position, n, seed, epoch)).withColumn("batch_id", batch_of("shuffled", size))


def rank_batches(df: DataFrame, position: str, total: int, world: int) -> DataFrame:
    """Rows dealt to ``world`` workers in turn; each worker's batch is its share of the total batch."""
    share = total // world
    if share == 0:
        raise ValueError("the total batch is smaller than the number of workers")
    pos = F.col(position)
    rank = pos % world
    return df.withColumn("rank", rank.cast("bigint")).withColumn(
        "batch_id", int_div(int_div(pos, world), share)
    )


def take_batches(df: DataFrame, count: int) -> DataFrame:
    return df.where(F.col("batch_id") < count)


def skip_batches(df: DataFrame, count: int) -> DataFrame:
    return df.where(F.col("batch_id") >= count)


def head_tail_batches(df: DataFrame, position: str, n_val_rows: int, size: int) -> tuple[DataFrame, DataFrame]:
    """The first n_val_rows // size batches for validation, the rest for training."""
    batched = batches(df, position, size)
    count = n_val_rows // size
    return take_batches(batched, count), skip_batches(batched, count)


def with_head_holdout(df: DataFrame, position: str, n_val_rows: int, size: int, name: str = "split") -> DataFrame:
    """The same hold-out as a label, for one pass over both parts."""
    count = n_val_rows // size
    return batches(df, position, size).withColumn(name, F.when(F.col("batch_id") < count, "val").otherwise("train"))
