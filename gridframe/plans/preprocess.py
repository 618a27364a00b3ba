"""From column records to sharded tables, catalogue, statistics and graphs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.operators import reshape
from gridframe.operators.index import plan_shards
from gridframe.operators.moments import merge_states, position_moments, position_states
from gridframe.operators.normalize import normalize
from gridframe.schema import CATALOG, MATRIX, VECTOR
from gridframe.sources.catalog import catalog_upsert, entry_of, load_states, load_stats, save_states, save_stats
from gridframe.sources.shards import write_graphs, write_shards

BUILDERS = {"flattened": reshape.flattened, "features": reshape.features}


def table_path(root: str, step: int, kind: str) -> str:
    return f"{root}/{kind}-{step}"


def stored_schema(kind: str) -> T.StructType:
    """Schema of a stored table; ``shard`` is its partition column."""
    cell = VECTOR if kind == "flattened" else MATRIX
    arrays = ["x", "y"] if kind == "flattened" else ["x", "y", "edge"]
    fields = [T.StructField("column_id", T.LongType()), *[T.StructField(a, cell) for a in arrays]]
    return T.StructType([*fields, T.StructField("shard", T.IntegerType())])


def read_table(spark: SparkSession, root: str, step: int, kind: str) -> DataFrame:
    return spark.read.schema(stored_schema(kind)).parquet(table_path(root, step, kind))


def build_table(
    columns: DataFrame, root: str, step: int, kind: str, target_shards: int, n_rows: int | None = None, files_per_shard: int = 1
) -> Row:
    """Build one kind of model input, store it in equal shards and enter it in the catalogue.

    ``column_id`` is dense. Shapes are observed while the rows are written, so the table is not read again; only
    extremes are taken from the observation, which a repeated task leaves as they are.
    """
    spark = columns.sparkSession
    n_rows = columns.count() if n_rows is None else n_rows
    plan = plan_shards(spark.createDataFrame([(n_rows,)], "n_rows bigint"), target_shards).first()
    built = BUILDERS[kind](columns)
    arrays = built.columns[1:]
    measures = []
    for name in arrays:
        sizes = [F.size(name)]
        if reshape.array_rank(built, name) > 1:
            sizes.append(F.size(F.get(F.col(name), F.lit(0))))
        for axis, size in enumerate(sizes):
            measures += [F.min(size).alias(f"{name}_{axis}_least"), F.max(size).alias(f"{name}_{axis}")]
    seen = Observation()
    write_shards(
        built.observe(seen, *measures), table_path(root, step, kind), plan["num_shards"], n_rows=n_rows, files_per_shard=files_per_shard
    )
    found = seen.get
    for key in [k for k in found if k.endswith("_least")]:
        if found[key] != found[key.removesuffix("_least")]:
            raise ValueError(f"records differ in the length of {key.split('_')[0]}")
    shape = {a: [found[f"{a}_{axis}"] for axis in (0, 1) if f"{a}_{axis}" in found] for a in arrays}
    dtype = {"float": "float32", "double": "float64"}[reshape.element_type(built, "x").simpleString()]
    entry = (step, kind, dtype, n_rows, plan["num_shards"], shape["x"], shape["y"], shape.get("edge"))
    catalog_upsert(spark, f"{root}/catalog", spark.createDataFrame([entry], CATALOG))
    return entry_of(spark, f"{root}/catalog", step, kind)


def build_stats(spark: SparkSession, root: str, step: int, kind: str) -> DataFrame:
    """Mean and deviation of every position of a stored table, stored beside it."""
    table = read_table(spark, root, step, kind)
    arrays = [a for a in ("x", "y", "edge") if a in table.columns]
    path = f"{root}/stats-{kind}-{step}"
    save_stats(position_moments(table, arrays), path)
    return load_stats(spark, path)


def update_stats(spark: SparkSession, root: str, step: int, kind: str) -> DataFrame:
    """Moments over all timesteps entered so far, of which only ``step`` is read: its states, shard by shard, are added to
    the stored ones (or replace its own), and those are merged."""
    table = read_table(spark, root, step, kind).withColumn("timestep", F.lit(step))
    arrays = [a for a in ("x", "y", "edge") if a in table.columns]
    save_states(position_states(table, arrays, ["timestep", "shard"]), f"{root}/states-{kind}")
    return merge_states(load_states(spark, f"{root}/states-{kind}"))


def normalized_table(spark: SparkSession, root: str, step: int, kind: str, arrays: Sequence[str] = ("x",)) -> DataFrame:
    """A stored table with arrays normalised by the stored statistics."""
    table = read_table(spark, root, step, kind)
    for name in arrays:
        table = normalize(table, name, load_stats(spark, f"{root}/stats-{kind}-{step}", [name]))
    return table


def build_graph_tables(spark: SparkSession, root: str, step: int) -> None:
    """Node and edge tables of the stored features, in the shards of the features."""
    write_graphs(read_table(spark, root, step, "features"), f"{root}/graphs-{step}")
