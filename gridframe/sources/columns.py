"""Reading column records by time and patch."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.functions.arrays import take_variable, to_unit_per_day
from gridframe.operators.batches import batches
from gridframe.operators.index import with_row_id
from gridframe.operators.normalize import normalize
from gridframe.schema import COLUMNS, FAMILIES, FLUXES, HEATING_RATES, family_of, variable_index

KEYS = ["timestep", "patch", "date", "column_id"]


def load_columns(
    spark: SparkSession,
    root: str,
    timesteps: Sequence[int] | None = None,
    patches: Sequence[int] | None = None,
    date: str | None = None,
    hr_units: str = "K s-1",
    minimal_outputs: bool = False,
    raw_inputs: bool = False,
    reject_missing: bool = False,
    all_present: bool = False,
    schema: T.StructType = COLUMNS,
) -> DataFrame:
    """Records of the chosen timesteps, patches and date.

    ``timestep`` and ``patch`` are partition columns, so the choice is made on directories. Heating rates lie on disk
    per second and are given per day on request. ``minimal_outputs`` keeps the fluxes only; ``raw_inputs`` gives each
    variable its own column in place of the grouped arrays; ``reject_missing`` fails the job on a missing value;
    ``all_present`` raises an error, from the directories alone, where a wanted timestep or patch is not stored.
    """
    if hr_units not in ("K s-1", "K d-1"):
        raise ValueError(f"unknown unit of heating rates: {hr_units}")
    df = spark.read.schema(schema).parquet(root)
    if all_present:
        _check_present(df, {"timestep": timesteps, "patch": patches})
    if timesteps is not None:
        df = df.where(F.col("timestep").isin(list(timesteps)))
    if patches is not None:
        df = df.where(F.col("patch").isin(list(patches)))
    if date is not None:
        df = df.where(F.col("date") == F.lit(date).cast("date"))
    inputs = raw_columns(df) if raw_inputs else [F.col(f) for f in FAMILIES if f in df.columns]
    outputs = [F.col(f) for f in FLUXES if f in df.columns]
    if not minimal_outputs:
        for name in [n for n in HEATING_RATES if n in df.columns]:
            outputs.append(to_unit_per_day(name).alias(name) if hr_units == "K d-1" else F.col(name))
    chosen = df.select(*[k for k in KEYS if k in df.columns], *inputs, *outputs)
    return reject_nulls(chosen, [c for c in chosen.columns if c not in KEYS]) if reject_missing else chosen


def _check_present(df: DataFrame, wanted: dict[str, Sequence[int] | None]) -> None:
    for name, values in wanted.items():
        if values is not None:
            stored = df.select(name).distinct().where(F.col(name).isin(list(values)))
            missing = sorted(set(values) - {row[0] for row in stored.collect()})
            if missing:
                raise ValueError(f"{name} not stored: {missing}")


def raw_columns(df: DataFrame) -> list:
    """One column per named variable: a scalar, or a profile over levels."""
    picked = []
    for family, names in FAMILIES.items():
        if family in df.columns:
            flat = df.schema[family].dataType.elementType.typeName() != "array"
            for i, name in enumerate(names):
                picked.append((F.get(F.col(family), F.lit(i)) if flat else take_variable(family, i)).alias(name))
    return picked


def pick_variable(df: DataFrame, name: str) -> DataFrame:
    """Add one variable by its name."""
    family = family_of(name)
    index = variable_index(family, name)
    flat = df.schema[family].dataType.elementType.typeName() != "array"
    return df.withColumn(name, F.col(family)[index] if flat else take_variable(family, index))


def every_nth(df: DataFrame, step: int, low: int = 0, high: int | None = None, column: str = "timestep") -> DataFrame:
    """Values low, low + step, ... up to high (inclusive), or without an end."""
    t = F.col(column)
    within = t >= low if high is None else t.between(low, high)
    return df.where(within & ((t - low) % step == 0))


def load_batched(
    df: DataFrame,
    array: str,
    stats: DataFrame,
    timesteps: Sequence[int],
    filenums: Sequence[int],
    batch_size: int,
    order_by: Sequence[str] = ("timestep", "filenum", "column_id"),
) -> DataFrame:
    """Records of the chosen timesteps and files, normalised, with their ``position`` and ``batch_id``."""
    chosen = df.where(F.col("timestep").isin(list(timesteps)) & F.col("filenum").isin(list(filenums)))
    placed = with_row_id(chosen, list(order_by), "position")
    return batches(normalize(placed, array, stats), "position", batch_size)


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Parts as one dataset along the row axis."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_parts(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Many files or directories as one dataset."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*paths)


def reject_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail the job on a record with a missing array or a missing value in one."""
    for name in columns:
        value = F.col(name)
        kind = df.schema[name].dataType
        missing = value.isNull()
        while isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
            value, kind = F.flatten(value), kind.elementType
        if isinstance(kind, T.ArrayType):
            missing = missing | F.coalesce(F.exists(value, lambda v: v.isNull()), F.lit(True))
        df = df.withColumn(name, F.when(missing, F.raise_error(F.lit(f"missing value in {name}"))).otherwise(F.col(name)))
    return df
