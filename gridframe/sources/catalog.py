"""Catalogue of written tables, keyed by (step, kind), and the stored statistics.

The catalogue is a log of commits. A writer stores its entries in a folder of its own and then makes the next file of the
log, which names the folder; the file is made only if there is none of its number, so of two writers one takes the next
number instead, and neither loses an entry. The later commit of a key counts. Every few commits the whole state is
committed once more, from which readers begin.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from gridframe.operators.reshape import array_rank, element_type
from gridframe.schema import CATALOG, STATS
from gridframe.session import create_once, list_files

#: Commits between two that hold the whole state.
COMPACT = 8


def describe_table(df: DataFrame, step: int, kind: str, shard: str | None = "shard") -> DataFrame:
    """The catalogue entry of a table, from one pass over its lengths: element type, rows, shards, array shapes."""
    arrays = [a for a in ("x", "y", "edge") if a in df.columns]
    measures = [F.count("*").alias("dataset_len")]
    measures.append((F.count_distinct(shard) if shard else F.lit(1)).cast("bigint").alias("num_shards"))
    for name in ("x", "y", "edge"):
        if name not in arrays:
            measures.append(F.lit(None).cast("array<int>").alias(f"{name}_shape"))
            continue
        axes = [_one_length(F.size(name), F.size(name), name)]
        if array_rank(df, name) > 1:
            widths = F.transform(name, lambda row: F.size(row))
            axes.append(_one_length(F.array_min(widths), F.array_max(widths), f"rows of {name}"))
        measures.append(F.array(*axes).alias(f"{name}_shape"))
    entry = df.agg(*measures)
    dtype = {"float": "float32", "double": "float64"}.get(element_type(df, arrays[0]).simpleString())
    columns = {"step": F.lit(step), "kind": F.lit(kind), "dtype": F.lit(dtype)}
    return entry.select(*[columns.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in CATALOG])


def _one_length(low: Column, high: Column, what: str) -> Column:
    """The one length all records share; a ragged table fails the job."""
    wrong = F.raise_error(F.concat(F.lit(f"{what} differ in length: "), F.min(low), F.lit(" to "), F.max(high)))
    return F.when(F.min(low) < F.max(high), wrong.cast("int")).otherwise(F.max(high))


def _commits(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Number and folder of the commits from the last whole state on."""
    names = [n for n in list_files(spark, f"{path}/log") if n.isdigit()]
    starts = [k for k, n in enumerate(names) if int(n) % (COMPACT + 1) == 0 and k]
    # Whole states stand at fixed numbers, so only the log's tail is read.
    rows = spark.read.text([f"{path}/log/{n}" for n in names[starts[-1] if starts else 0 :]]).collect() if names else []
    return sorted((int(number), folder) for number, folder in (r["value"].split(" ") for r in rows))


def catalog_upsert(spark: SparkSession, path: str, entries: DataFrame) -> int:
    """Insert or replace the given (step, kind) entries and keep the others; the number of the commit. Writers may work
    at the same time: each tries again with the next number until it has one of its own."""
    folder = f"data-{uuid.uuid4().hex}"
    entries.select(*CATALOG.names).repartition(1).write.parquet(f"{path}/{folder}")
    while True:
        number = max((int(n) for n in list_files(spark, f"{path}/log") if n.isdigit()), default=0) + 1
        if number % (COMPACT + 1) == 0:
            _commit_state(spark, path, number)
        elif create_once(spark, f"{path}/log/{number:012d}", f"{number} {folder}"):
            return number


def _commit_state(spark: SparkSession, path: str, number: int) -> None:
    """Commit the whole state under a number kept for it; of several writers one does."""
    folder = f"data-{uuid.uuid4().hex}"
    read_catalog(spark, path).repartition(1).write.parquet(f"{path}/{folder}")
    create_once(spark, f"{path}/log/{number:012d}", f"{number} {folder}")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Every entry in its latest commit."""
    commits = _commits(spark, path)
    if not commits:
        raise FileNotFoundError(path)
    parts = [spark.read.schema(CATALOG).parquet(f"{path}/{folder}").withColumn("_at", F.lit(number)) for number, folder in commits]
    every = reduce(DataFrame.unionByName, parts)
    newest = every.groupBy("step", "kind").agg(F.max_by(F.struct(*CATALOG.names), "_at").alias("e"))
    return newest.select("e.*")


def catalog_get(spark: SparkSession, path: str, step: int, kind: str) -> DataFrame:
    """The one-row entry of a table."""
    return read_catalog(spark, path).where((F.col("step") == step) & (F.col("kind") == kind))


def entry_of(spark: SparkSession, path: str, step: int, kind: str) -> Row:
    row = catalog_get(spark, path, step, kind).first()
    if row is None:
        raise KeyError((step, kind))
    return row


def save_stats(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store a statistics table (array, pos, n, mean, std): one row per array position."""
    stats.select("array", "pos", "n", "mean", "std").repartition(1).write.mode(mode).parquet(path)


def load_stats(spark: SparkSession, path: str, arrays: Sequence[str] | None = None) -> DataFrame:
    stats = spark.read.schema(STATS).parquet(path)
    return stats.where(F.col("array").isin(list(arrays))) if arrays is not None else stats


def save_states(states: DataFrame, path: str, step: str = "timestep") -> None:
    """Add the states of new steps (array, pos, n, mean, m2 by ``step`` and whatever parts it has) to those stored; a
    step that is given again replaces its own, and no other is touched."""
    states.repartition(1, step).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(step).parquet(path)


def load_states(spark: SparkSession, path: str, arrays: Sequence[str] | None = None) -> DataFrame:
    states = spark.read.parquet(path)
    return states.where(F.col("array").isin(list(arrays))) if arrays is not None else states
