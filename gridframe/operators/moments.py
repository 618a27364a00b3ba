"""Means, population deviations, histograms and correlations in one distributed pass.

Values are brought to long form and aggregated there: the generator and the partial aggregation run in generated code
on the side of the scan, so that what is shuffled is one row per task and group, however hot a group is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridframe.functions.arrow import matrix, nested
from gridframe.operators.reshape import array_rank, as_vector, element_type


def _long_positions(df: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """(array number, pos, value) of all arrays from one scan."""
    widest = "double" if len({element_type(df, a).simpleString() for a in arrays}) > 1 else None
    parts = []
    for number, name in enumerate(arrays):
        vector = as_vector(df, name)
        parts.append(F.struct(F.lit(number).alias("a"), (vector.cast("array<double>") if widest else vector).alias("v")))
    if len(parts) == 1:
        return df.select(F.lit(0).alias("a"), F.posexplode(parts[0]["v"]).alias("pos", "value"))
    return df.select(F.inline(F.array(*parts))).select("a", F.posexplode("v").alias("pos", "value"))


def position_moments(df: DataFrame, arrays: Sequence[str], route: str = "explode") -> DataFrame:
    """Count, mean and population deviation along the rows for every array position, arrays of any rank.

    ``explode`` aggregates in long form; ``summarizer`` keeps each record's vector whole.
    """
    if route == "summarizer":
        parts = [_summarized(df, name) for name in arrays]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
    value = F.col("value").cast("double")
    moments = (
        _long_positions(df, arrays)
        .groupBy("a", "pos")
        .agg(F.count("value").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    )
    name = F.element_at(F.array(*[F.lit(a) for a in arrays]), F.col("a") + 1)
    return moments.select(name.alias("array"), "pos", "n", "mean", "std")


def position_states(df: DataFrame, arrays: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Mergeable moments of every part of the rows: (by..., array, pos, n, mean, m2), m2 the summed squared deviations."""
    parts = []
    for name in arrays:
        value = F.col("value").cast("double")
        long = df.select(*by, F.posexplode(as_vector(df, name)).alias("pos", "value")).groupBy(*by, "pos")
        n, spread = F.count("value"), F.var_pop(value)
        parts.append(long.agg(n.alias("n"), F.avg(value).alias("mean"), (spread * n).alias("m2")).withColumn("array", F.lit(name)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*by, "array", "pos", "n", "mean", "m2")


def merge_states(states: DataFrame) -> DataFrame:
    """Count, mean and population deviation per array position from the states of all parts.

    Each part's squared deviations are moved to the common mean, so nothing is lost where means are large. Parts without
    a value do not count.
    """
    filled = states.where("n > 0")
    n, mean = F.sum("n"), F.sum(F.col("n") * F.col("mean")) / F.sum("n")
    common = filled.groupBy("array", "pos").agg(n.alias("total"), mean.alias("common"))
    shift = F.col("mean") - F.col("common")
    moved = filled.join(common, ["array", "pos"]).groupBy("array", "pos", "total", "common")
    merged = moved.agg(F.sqrt(F.sum(F.col("m2") + F.col("n") * shift * shift) / F.col("total")).alias("std"))
    return merged.select("array", "pos", F.col("total").alias("n"), F.col("common").alias("mean"), "std")


def _summarized(df: DataFrame, name: str, groups: int = 64) -> DataFrame:
    """Vector summaries of a fixed number of row groups, merged per position: no task merges all partial vectors."""
    vectors = df.select((F.spark_partition_id() % groups).alias("g"), array_to_vector(as_vector(df, name)).alias("v"))
    summary = vectors.groupBy("g").agg(Summarizer.metrics("count", "mean", "variance").summary(F.col("v")).alias("s"))
    parts = summary.select(
        F.col("s.count").alias("n"),
        F.arrays_zip(vector_to_array("s.mean").alias("m"), vector_to_array("s.variance").alias("q")).alias("z"),
    ).select("n", F.posexplode("z").alias("pos", "z"))
    # The summary gives the sample variance; the squared deviations are merged around the common mean.
    n, mean = F.col("n"), F.col("z.m")
    by_pos = W.partitionBy("pos")
    total = F.sum(n).over(by_pos)
    common = F.sum(n * mean).over(by_pos) / total
    merged = parts.select("pos", "n", mean.alias("m"), F.col("z.q").alias("q"), common.alias("c")).groupBy("pos")
    squares = F.sum(F.col("q") * (n - 1) + n * (F.col("m") - F.col("c")) * (F.col("m") - F.col("c")))
    return merged.agg(
        F.lit(name).alias("array"),
        F.sum("n").alias("total"),
        F.first("c").alias("mean"),
        F.sqrt(squares / F.sum("n")).alias("std"),
    ).select("array", "pos", F.col("total").alias("n"), "mean", "std")


def position_mean(df: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """Mean along the rows for every array position."""
    means = _long_positions(df, arrays).groupBy("a", "pos").agg(F.avg(F.col("value").cast("double")).alias("mean"))
    name = F.element_at(F.array(*[F.lit(a) for a in arrays]), F.col("a") + 1)
    return means.select(name.alias("array"), "pos", "mean")


def _long_profile(df: DataFrame, matrix: str) -> DataFrame:
    """(level, variable, value) of a levels x variables matrix."""
    return df.select(F.posexplode(matrix).alias("level", "row")).select("level", F.posexplode("row").alias("variable", "value"))


def variable_moments(df: DataFrame, family: str, names: Sequence[str] | None = None) -> DataFrame:
    """Mean and deviation of each variable over all its values: rows, and levels where the family has them."""
    if array_rank(df, family) > 1:
        long = _long_profile(df, family)
    else:
        long = df.select(F.posexplode(family).alias("variable", "value"))
    value = F.col("value").cast("double")
    out = long.groupBy("variable").agg(
        F.count("value").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")
    )
    if names is not None:
        out = out.withColumn("name", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("variable") + 1))
    return out


def profile_moments(df: DataFrame, matrix: str) -> DataFrame:
    """Vertical profile: mean and deviation of each variable per level."""
    value = F.col("value").cast("double")
    if array_rank(df, matrix) > 1:
        long, keys = _long_profile(df, matrix), ["variable", "level"]
    else:
        long, keys = df.select(F.posexplode(matrix).alias("level", "value")), ["level"]
    return long.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def histogram(df: DataFrame, value: str | Column, bins: int = 150) -> DataFrame:
    """Equal-width bins from the least to the greatest value, the last one closed on the right.

    Every bin is given, also an empty one; ``density`` integrates to one. A constant input v has the range v - 0.5
    to v + 0.5. One pass finds the range, a second counts.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    values = df.select(v.alias("v"))
    low, high = F.min("v"), F.max("v")
    flat = low == high
    span = values.agg(
        F.when(flat, low - 0.5).otherwise(low).alias("low"), F.when(flat, high + 0.5).otherwise(high).alias("high")
    ).select(F.struct("low", "high", ((F.col("high") - F.col("low")) / bins).alias("width")))
    placed = values.withColumn("r", span.scalar())
    low, width, x = F.col("r.low"), F.col("r.width"), F.col("v")
    guess = F.least(F.floor((x - low) * bins / (F.col("r.high") - low)), F.lit(bins - 1)).cast("int")
    # A value next to an edge is put on the side of the edge it lies on.
    exact = (
        F.when(x < low + F.col("g") * width, F.col("g") - 1)
        .when((x >= low + (F.col("g") + 1) * width) & (F.col("g") < bins - 1), F.col("g") + 1)
        .otherwise(F.col("g"))
    )
    counts = placed.where(x.isNotNull()).withColumn("g", guess).groupBy(exact.alias("bin")).agg(F.count("*").alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    filled = every.join(counts, "bin", "left").select("bin", F.coalesce("count", F.lit(0)).alias("count"))
    total = F.sum("count").over(W.partitionBy())
    return filled.withColumn("r", span.scalar()).select(
        "bin",
        (F.col("r.low") + F.col("bin") * F.col("r.width")).alias("low"),
        F.when(F.col("bin") == bins - 1, F.col("r.high")).otherwise(F.col("r.low") + (F.col("bin") + 1) * F.col("r.width")).alias("high"),
        "count",
        (F.col("count") / (total * F.col("r.width"))).alias("density"),
    )


def array_histogram(df: DataFrame, array: str, bins: int = 150) -> DataFrame:
    """Histogram over all values of an array column."""
    return histogram(df.select(F.explode(as_vector(df, array)).alias("value")), "value", bins)


def stats_table(stats: DataFrame) -> DataFrame:
    """The statistics under the names ``{array}_mean`` and ``{array}_std``: (name, pos, value)."""
    pairs = F.array(
        F.struct(F.concat("array", F.lit("_mean")).alias("name"), "pos", F.col("mean").alias("value")),
        F.struct(F.concat("array", F.lit("_std")).alias("name"), "pos", F.col("std").alias("value")),
    )
    return stats.select(F.inline(pairs))


def stats_record(stats: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """The statistics as one row of arrays ``{array}_mean``, ``{array}_std``; as long as a record, whatever the data."""
    ordered = stats.groupBy("array").agg(F.array_sort(F.collect_list(F.struct("pos", "mean", "std"))).alias("s"))
    picked = []
    for name in arrays:
        mine = F.max(F.when(F.col("array") == name, F.col("s")))
        picked += [F.transform(mine, lambda r: r[k]).alias(f"{name}_{k}") for k in ("mean", "std")]
    return ordered.groupBy().agg(*picked)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("dataset_len"))


def screen_variables(df: DataFrame, values: Sequence[str], least_std: float, redundant: float) -> tuple[DataFrame, DataFrame]:
    """Which variables hardly vary, and which pairs are strongly correlated.

    The first table is (name, std, useless), the second (left, right, corr, redundant). Each is one pass of plain
    aggregates, as many as there are columns or pairs of columns.
    """
    spread = df.agg(*[F.stddev_pop(v).alias(v) for v in values])
    lines = [F.struct(F.lit(v).alias("name"), F.col(v).alias("std")) for v in values]
    spread = spread.select(F.inline(F.array(*lines))).withColumn("useless", F.col("std") < least_std)
    pairs = list(combinations(range(len(values)), 2))
    together = df.agg(*[F.corr(values[i], values[j]).alias(f"_{i}_{j}") for i, j in pairs])
    lines = [
        F.struct(F.lit(values[i]).alias("left"), F.lit(values[j]).alias("right"), F.col(f"_{i}_{j}").alias("corr"))
        for i, j in pairs
    ]
    together = together.select(F.inline(F.array(*lines))).withColumn("redundant", F.abs("corr") >= redundant)
    return spread, together


def screen_positions(df: DataFrame, array: str, redundant: float) -> DataFrame:
    """Pairs of array positions with their correlation: (left, right, corr, redundant), left before right.

    Two passes: the means, then each task's matrix of centred products, which leaves it as one row per position however
    many records it read and is summed by position. Ragged or missing records fail the job. Constant positions have no
    correlation.
    """
    rows = position_mean(df, [array]).orderBy("pos").collect()
    centre = np.array([r["mean"] for r in rows], dtype="f8")

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centre), len(centre)))
        for batch in batches:
            if batch.num_rows:
                gap = matrix(batch.column(0)) - centre
                total += gap.T @ gap
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(centre)), pa.int64()), nested(total)], names=["left", "row"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(matrix(batch.column("row")).sum(axis=0) for batch in batches)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), nested(total[None])], names=["left", "row"])

    kind = "left bigint, row array<double>"
    sums = df.select(array).mapInArrow(products, kind).groupBy("left").applyInArrow(add, kind)
    own = sums.select(F.col("left").alias("right"), F.get("row", F.col("left").cast("int")).alias("spread"))
    mine = F.get("row", F.col("left").cast("int"))
    pairs = sums.select("left", mine.alias("_spread"), F.posexplode("row").alias("right", "together")).where("right > left")
    pairs = pairs.withColumn("right", F.col("right").cast("bigint")).join(own, "right")
    scale = F.sqrt(F.col("_spread") * F.col("spread"))
    corr = F.when(scale > 0, F.col("together") / scale)
    return pairs.select("left", "right", corr.alias("corr")).withColumn("redundant", F.abs("corr") >= redundant)
