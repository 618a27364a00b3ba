"""Sharded storage of row-aligned arrays: one Parquet table, one directory per shard, whole rows in each shard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.functions.arrays import int_div
from gridframe.operators.index import rechunk_rows, with_shard
from gridframe.operators.pathgraph import graph_edges, graph_nodes
from gridframe.session import delete_path, scratch_path


def _writer(df: DataFrame, mode: str) -> DataFrameWriter:
    """A writer that spares float arrays the dictionary attempt: measurements hardly repeat."""
    writer = df.write.mode(mode)
    for field in df.schema.fields:
        kind, path = field.dataType, field.name
        while isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, f"{path}.list.element"
        if isinstance(kind, (T.FloatType, T.DoubleType)) and path != field.name:
            writer = writer.option(f"parquet.enable.dictionary#{path}", "false")
    return writer


def _equal_parts(n_rows: int, num_shards: int, uneven: bool) -> tuple[int, int]:
    """Rows of a shard, and the number of shards: with ``uneven`` the rows left over fill further ones, the last of
    which may be short."""
    size = n_rows // num_shards
    if n_rows % num_shards and not (uneven and size):
        raise ValueError(f"{n_rows} rows cannot be cut into {num_shards} equal shards")
    return size, -(-n_rows // size) if size else num_shards


def write_shards(
    df: DataFrame,
    path: str,
    num_shards: int,
    row_id: str = "column_id",
    n_rows: int | None = None,
    mode: str = "overwrite",
    files_per_shard: int = 1,
    uneven: bool = False,
) -> None:
    """Equal shards of consecutive rows, rows in order, one file each (or a few, where a shard is more than a task
    should write).

    ``row_id`` is dense. The row count is taken from the caller (the catalogue knows it) or counted, and must be a
    multiple of ``num_shards`` (see ``plan_shards``) or, with ``uneven``, at least as large: shards then have
    ``n_rows // num_shards`` rows, and those left over follow in further shards, the last one short.
    """
    n_rows = df.count() if n_rows is None else n_rows
    size, num_shards = _equal_parts(n_rows, num_shards, uneven)
    shards = rechunk_rows(df, row_id, size, num_shards, files_per_shard)
    _writer(shards, mode).partitionBy("shard").parquet(path)


def write_container(df: DataFrame, path: str, row_id: str = "column_id", mode: str = "overwrite") -> None:
    """One table holding the arrays side by side, sorted by position so that ranges skip row groups."""
    _writer(df.repartitionByRange(row_id).sortWithinPartitions(row_id), mode).parquet(path)


def read_shards(spark: SparkSession, path: str, arrays: Sequence[str], schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """The named arrays of a shard stack or container; other arrays are not read."""
    return spark.read.schema(schema).parquet(path).select(*keep, *arrays)


def read_shard(
    spark: SparkSession, path: str, shard: int, schema: T.StructType, entry: Row | None = None
) -> DataFrame:
    """One shard, from its directory alone, with lengths held against the catalogue entry."""
    df = spark.read.schema(schema).parquet(path).where(F.col("shard") == shard)
    return check_shapes(df, entry) if entry is not None else df


def check_shapes(df: DataFrame, entry: Row) -> DataFrame:
    """Fail the job where an array's length differs from the declared one."""
    for name in ("x", "y", "edge"):
        shape = entry[f"{name}_shape"]
        if shape is None or name not in df.columns:
            continue
        ok = F.size(name) == shape[0]
        if len(shape) > 1:
            ok = ok & _rows_of_width(name, shape[1])
        wrong = F.raise_error(F.concat(F.lit(f"{name} is not of shape {list(shape)} but has length "), F.size(name)))
        df = df.withColumn(name, F.when(ok, F.col(name)).otherwise(wrong))
    return df


def _rows_of_width(name: str, width: int) -> Column:
    return F.forall(name, lambda row: F.size(row) == width)


def read_rows(spark: SparkSession, path: str, start: int, end: int, schema: T.StructType, row_id: str = "column_id") -> DataFrame:
    """Rows of the half-open range [start, end); row groups outside it are skipped by their statistics."""
    df = spark.read.schema(schema).parquet(path)
    return df.where((F.col(row_id) >= start) & (F.col(row_id) < end))


def reshard(
    df: DataFrame,
    path: str,
    ranks: int,
    files_per_rank: int,
    rows_per_file: int,
    row_id: str = "column_id",
    mode: str = "overwrite",
) -> None:
    """A container as ranks x files pieces of equal rows: disjoint, complete, one directory per piece.

    The pieces must have room for every row; fewer rows leave the last pieces short or empty.
    """
    room = ranks * files_per_rank * rows_per_file
    top = df.agg(F.max(row_id)).first()[0]
    if top is not None and top >= room:
        raise ValueError(f"position {top} does not fit into {room} rows")
    placed = with_shard(df, row_id, rows_per_file).withColumn("rank", int_div("shard", files_per_rank).cast("int"))
    laid_out = placed.repartitionById(ranks * files_per_rank, F.col("shard"))
    laid_out = laid_out.sortWithinPartitions("rank", "shard", row_id)
    _writer(laid_out, mode).partitionBy("rank", "shard").parquet(path)


def write_graphs(
    features: DataFrame,
    path: str,
    num_shards: int | None = None,
    n_columns: int | None = None,
    row_id: str = "column_id",
    mode: str = "overwrite",
    uneven: bool = False,
) -> None:
    """Node and edge tables of the records' path graphs, grouped by the shard a record came from.

    Records read from a shard stack carry ``shard`` and lie together already: their graphs are written where they are
    built. Others are laid out in ``num_shards`` (``uneven`` as in ``write_shards``) and stored once, as records, which are
    far smaller than their edges; both tables are built from what was stored, which is then deleted.
    """
    stored = None
    if "shard" not in features.columns:
        n_columns = features.count() if n_columns is None else n_columns
        size, num_shards = _equal_parts(n_columns, num_shards, uneven)
        stored = scratch_path(features.sparkSession, "features")
        laid_out = rechunk_rows(features, row_id, size, num_shards)
        _writer(laid_out, "overwrite").partitionBy("shard").parquet(stored)
        features = features.sparkSession.read.parquet(stored)
    for name, build in (("nodes", graph_nodes), ("edges", graph_edges)):
        _writer(build(features, ("shard", row_id)), mode).partitionBy("shard").parquet(f"{path}/{name}")
    if stored:
        delete_path(features.sparkSession, stored)
