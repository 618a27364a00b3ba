"""Model inputs built from column records, and reports on their shape, size and layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.functions.arrays import add_axis, concat_features, flatten_row, node_features, node_targets
from gridframe.schema import FEATURES, FLUXES


def array_rank(df: DataFrame, name: str) -> int:
    """Nesting depth of an array column."""
    kind, rank = df.schema[name].dataType, 0
    while isinstance(kind, T.ArrayType):
        kind, rank = kind.elementType, rank + 1
    return rank


def element_type(df: DataFrame, name: str) -> T.DataType:
    kind = df.schema[name].dataType
    while isinstance(kind, T.ArrayType):
        kind = kind.elementType
    return kind


def as_vector(df: DataFrame, name: str) -> Column:
    """Any array column as a row-major vector."""
    vector = F.col(name)
    for _ in range(array_rank(df, name) - 1):
        vector = F.flatten(vector)
    return vector


def select_features(df: DataFrame, names: Sequence[str] = FEATURES, keep: Sequence[str] = ("column_id",)) -> DataFrame:
    """The variables models are built from, with the record keys."""
    return df.select(*keep, *names)


def flattened(df: DataFrame, keep: Sequence[str] = ("column_id",)) -> DataFrame:
    """x: half-level, interface, scalar and layer inputs in one vector; y: the four fluxes in one vector."""
    x = concat_features(
        flatten_row("hl_inputs"), flatten_row("inter_inputs"), F.col("sca_inputs"), flatten_row("col_inputs")
    )
    return df.select(*keep, x.alias("x"), concat_features(*FLUXES).alias("y"))


def features(df: DataFrame, keep: Sequence[str] = ("column_id",)) -> DataFrame:
    """x: node features; y: node targets; edge: layer attributes."""
    x = node_features("hl_inputs", "inter_inputs", "sca_inputs", element_type(df, "sca_inputs").simpleString())
    return df.select(*keep, x.alias("x"), node_targets(*FLUXES).alias("y"), F.col("col_inputs").alias("edge"))


def flux_axis(df: DataFrame, name: str) -> DataFrame:
    """A profile with a trailing axis of length one."""
    return df.withColumn(name, add_axis(name))


def _inner_size(df: DataFrame, name: str) -> Column:
    return F.max(F.size(F.get(F.col(name), F.lit(0)))) if array_rank(df, name) > 1 else F.lit(None).cast("int")


def shape_report(df: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """One row per array: row count, and the length of each axis."""
    measures = [F.count("*").alias("n_rows")]
    for i, name in enumerate(arrays):
        measures += [F.max(F.size(name)).alias(f"_a{i}"), _inner_size(df, name).alias(f"_b{i}")]
    lines = [
        F.struct(F.lit(name).alias("array"), F.col("n_rows"), F.col(f"_a{i}").alias("axis_1"), F.col(f"_b{i}").alias("axis_2"))
        for i, name in enumerate(arrays)
    ]
    return df.agg(*measures).select(F.inline(F.array(*lines)))


# Bytes per element.
WIDTHS = {"float": 4, "double": 8, "int": 4, "bigint": 8, "smallint": 2, "tinyint": 1, "boolean": 1}


def size_report(df: DataFrame, arrays: Sequence[str], instant: str | None = None) -> DataFrame:
    """Bytes held by the arrays and, where a time column is named, the number of instants."""
    row_bytes = F.lit(0).cast("bigint")
    for name in arrays:
        cells = F.size(as_vector(df, name))
        row_bytes = row_bytes + cells.cast("bigint") * WIDTHS[element_type(df, name).simpleString()]
    measures = [F.count("*").alias("n_rows"), F.sum(row_bytes).alias("n_bytes")]
    if instant:
        measures.append(F.count_distinct(instant).alias("n_instants"))
    return df.agg(*measures)


def layout_report(df: DataFrame, row_id: str, shard: str = "shard") -> DataFrame:
    """Rows and position range of every shard."""
    return df.groupBy(shard).agg(
        F.count("*").alias("n_rows"), F.min(row_id).alias("first_id"), F.max(row_id).alias("last_id")
    )
