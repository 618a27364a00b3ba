"""Data skipping: which files of a table can hold a wanted id.

A zone map has the least and greatest id of every file. Fetching rows by id opens only files whose zone holds one of the
ids; inside them row groups are skipped by their statistics and by Bloom filters on the id, where ids are few.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.sources.shards import _writer

ZONES = "file string, low bigint, high bigint, n_rows bigint"

# Up to this many ids are pushed to the scan as single values, which is what Bloom filters and statistics answer.
PUSHED = 10


def write_indexed(df: DataFrame, path: str, zones: str, row_id: str, mode: str = "overwrite") -> None:
    """The table with Bloom filters on ``row_id``, and its zone map at ``zones``."""
    _writer(df, mode).option(f"parquet.bloom.filter.enabled#{row_id}", "true").parquet(path)
    zone_map(df.sparkSession.read.schema(df.schema).parquet(path), row_id).repartition(1).write.mode(mode).parquet(zones)


def zone_map(df: DataFrame, row_id: str) -> DataFrame:
    """(file, low, high, n_rows) of a frame straight from a Parquet read; only the id is read. Null ids are in no zone."""
    at = df.select(F.col(row_id).cast("bigint").alias("id"), F.col("_metadata.file_path").alias("file"))
    return at.groupBy("file").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("id").alias("n_rows"))


def files_with(ids: DataFrame, row_id: str, zones: DataFrame) -> list[str]:
    """The files whose zone holds one of the ids. The zone map comes to the driver as the list of files itself does;
    ids stay where they are, and a task gives each zone at most once."""
    known = zones.where("low IS NOT NULL").orderBy("file").toPandas()
    low, high = known["low"].to_numpy(dtype="int64"), known["high"].to_numpy(dtype="int64")

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(low), dtype=bool)
        for batch in batches:
            wanted = np.sort(batch.column(0).to_numpy(zero_copy_only=False))
            found |= np.searchsorted(wanted, low, "left") < np.searchsorted(wanted, high, "right")
        yield pa.RecordBatch.from_pydict({"zone": pa.array(np.flatnonzero(found), pa.int64())})

    wanted = ids.select(F.col(row_id).cast("bigint").alias("id")).where("id IS NOT NULL")
    rows = wanted.mapInArrow(hit, "zone bigint").distinct().collect()
    return [unquote(known["file"][int(r["zone"])]) for r in sorted(rows, key=lambda r: r["zone"])]


def fetch_indexed(spark: SparkSession, path: str, zones: str, ids: DataFrame, row_id: str, schema: T.StructType) -> DataFrame:
    """Rows of the table whose id is among ``ids``, from the files that may hold one.

    Repeated ids give a row once, ids without a row nothing, null ids nothing.
    """
    wanted = ids.select(row_id).where(F.col(row_id).isNotNull()).distinct()
    files = files_with(wanted, row_id, spark.read.schema(ZONES).parquet(zones))
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*files)
    few = wanted.limit(PUSHED + 1).collect()
    if len(few) <= PUSHED:
        return rows.where(F.col(row_id).isin([r[0] for r in few]))
    return rows.join(wanted, row_id, "left_semi")
