"""Errors of predictions against targets, over all elements of all rows.

A row whose prediction and target differ in length, or lack one of them, fails the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.functions.arrays import zip_equal
from gridframe.operators.reshape import as_vector


def _errors(df: DataFrame, pairs: dict[str, tuple[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """(output number, keys, predicted, true) in long form from one scan."""
    zipped = [
        F.struct(
            F.lit(i).alias("o"),
            zip_equal(p=as_vector(df, p).cast("array<double>"), t=as_vector(df, t).cast("array<double>")).alias("z"),
        )
        for i, (p, t) in enumerate(pairs.values())
    ]
    return df.select(*keep, F.inline(F.array(*zipped))).select(*keep, "o", F.inline("z"))


def _square() -> Column:
    gap = F.col("p") - F.col("t")
    return gap * gap


def mse(df: DataFrame, pred: str, target: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean squared error over all elements, with the element count."""
    return _errors(df, {"": (pred, target)}, by).groupBy(*by).agg(F.count("*").alias("n"), F.avg(_square()).alias("mse"))


def mae(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Mean absolute error of each output."""
    name = F.element_at(F.array(*[F.lit(o) for o in pairs]), F.col("o") + 1)
    errors = _errors(df, pairs).groupBy("o").agg(F.avg(F.abs(F.col("p") - F.col("t"))).alias("mae"))
    return errors.select(name.alias("output"), "mae")


def weighted_mse(df: DataFrame, pairs: dict[str, tuple[str, str]], weights: dict[str, float] | None = None) -> DataFrame:
    """One row: the mean squared error of each output and their weighted sum (weight 1 where none is given)."""
    weights = weights or {}
    of = [F.avg(F.when(F.col("o") == i, _square())).alias(f"mse_{name}") for i, name in enumerate(pairs)]
    loss = sum((F.col(f"mse_{name}") * float(weights.get(name, 1.0)) for name in pairs), F.lit(0.0))
    return _errors(df, pairs).agg(*of).withColumn("loss", loss)


def stage_metrics(df: DataFrame, stage: str, batch: str, pred: str, target: str) -> DataFrame:
    """Loss of every batch of every stage, with the rows it was taken over."""
    zipped = zip_equal(p=as_vector(df, pred).cast("array<double>"), t=as_vector(df, target).cast("array<double>"))
    values = df.select(stage, batch, F.posexplode(zipped).alias("at", "z")).select(stage, batch, "at", "z.p", "z.t")
    return values.groupBy(stage, batch).agg(F.avg(_square()).alias("loss"), F.count_if(F.col("at") == 0).alias("n_rows"))


def epoch_metrics(per_batch: DataFrame, stage: str) -> DataFrame:
    """Loss of a stage: batch losses weighted by rows, as the last batch may be short."""
    weighted = F.sum(F.col("loss") * F.col("n_rows")) / F.sum("n_rows")
    return per_batch.groupBy(stage).agg(weighted.alias("loss"), F.sum("n_rows").alias("n_rows"))
