"""Strongly correlated array positions without the matrix of all pairs."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.functions.arrow import matrix, nested
from gridframe.operators.moments import position_moments

#: Standard errors by which a sketched correlation may lie below the limit and still be looked at.
_MARGIN = 6.0
#: Positions whose sketches one task compares with all, and pairs whose products it sends in a row.
_STRIP, _PAIRS = 256, 4096


def signs(row_ids: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Rows x size random signs that depend on the row's id alone."""
    x = row_ids.astype("int64").view("uint64")[:, None] * np.uint64(0x9E3779B97F4A7C15)
    x = x + (np.arange(ceil(size / 64), dtype="uint64") + np.uint64(1 + (seed << 20))) * np.uint64(0xD6E8FEB86659FD93)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    bits = np.unpackbits((x ^ (x >> np.uint64(31))).view("uint8"), axis=1)[:, :size]
    return bits.astype("f8") * 2.0 - 1.0


def _added(df: DataFrame, key: str) -> DataFrame:
    """Vectors ``row`` summed by ``key``: each task has sent one for a key at most."""
    kind = f"{key} bigint, row array<double>"

    def add(of: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(matrix(batch.column("row")).sum(axis=0) for batch in batches)
        yield pa.RecordBatch.from_arrays([pa.array([of[0].as_py()], pa.int64()), nested(total[None])], names=[key, "row"])

    return df.groupBy(key).applyInArrow(add, kind)


def correlated_positions(df: DataFrame, array: str, row_id: str, least: float, size: int = 256) -> DataFrame:
    """Pairs of positions with a correlation of at least ``least`` in size: (left, right, corr), left before right.

    Three passes. The means and deviations; then every position's standardised values are projected on ``size`` random
    signs per row, and pairs whose projections are near enough to the limit are kept, with a margin of six standard errors
    of such an estimate; then the exact products of those pairs. A task sends ``size`` numbers per position, then one per
    kept pair, never a square of the positions. The projections, as long as a record times ``size``, and the kept pairs
    come to the driver and go out again. ``row_id`` tells rows apart; constant positions have no correlation; ragged or
    missing records fail.
    """
    spark = df.sparkSession
    stats = position_moments(df, [array]).orderBy("pos").collect()
    mean, std = (np.array([r[c] for r in stats], dtype="f8") for c in ("mean", "std"))
    varies, n = std > 0, stats[0]["n"] if stats else 0
    scale = np.where(varies, std, 1.0)
    rows = df.select(F.col(row_id).cast("bigint").alias("id"), F.col(array).alias("x"))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(mean), size))
        for batch in batches:
            if batch.num_rows:
                total += ((matrix(batch.column("x")) - mean) / scale).T @ signs(batch.column("id").to_numpy(zero_copy_only=False), size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(mean)), pa.int64()), nested(total)], names=["pos", "row"])

    found = _added(rows.mapInArrow(projected, "pos bigint, row array<double>"), "pos").orderBy("pos").collect() if len(mean) else []
    sketch = np.array([r["row"] for r in found], dtype="f8").reshape(len(mean), size)
    length = np.sqrt((sketch * sketch).sum(axis=1))
    sketch[~varies] = 0.0
    sketch /= np.where(length > 0, length, 1.0)[:, None]
    limit = least - _MARGIN * ((1.0 - least * least) / sqrt(size) + 1.0 / size)
    shared = spark.sparkContext.broadcast(sketch)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for strip in batch.column(0).to_pylist():
                left = np.arange(strip * _STRIP, min((strip + 1) * _STRIP, len(shared.value)))
                alike = np.abs(shared.value[left] @ shared.value.T) >= limit
                alike &= np.arange(len(shared.value)) > left[:, None]
                a, b = np.nonzero(alike)
                yield pa.RecordBatch.from_arrays([pa.array(left[a], pa.int64()), pa.array(b, pa.int64())], names=["left", "right"])

    strips = spark.range(ceil(len(mean) / _STRIP)).repartition(max(1, ceil(len(mean) / _STRIP)))
    pairs = sorted((r["left"], r["right"]) for r in strips.mapInArrow(near, "left bigint, right bigint").collect() if varies[r["left"]] and varies[r["right"]])
    ends = np.array(pairs, dtype="int64").reshape(-1, 2)
    kept = spark.sparkContext.broadcast(ends)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(kept.value))
        for batch in batches:
            if batch.num_rows:
                z = (matrix(batch.column("x")) - mean) / scale
                for start in range(0, len(total), _PAIRS):
                    a, b = kept.value[start : start + _PAIRS].T
                    total[start : start + _PAIRS] += np.einsum("ij,ij->j", z[:, a], z[:, b])
        for start in range(0, len(total), _PAIRS):
            row = nested(total[None, start : start + _PAIRS])
            yield pa.RecordBatch.from_arrays([pa.array([start // _PAIRS], pa.int64()), row], names=["block", "row"])

    sums = _added(rows.mapInArrow(products, "block bigint, row array<double>"), "block")
    place = F.posexplode("row").alias("at", "together")
    together = sums.select("block", place).select((F.col("block") * _PAIRS + F.col("at")).alias("pair"), (F.col("together") / max(n, 1)).alias("corr"))
    named = spark.createDataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(ends)], "pair bigint, left bigint, right bigint")
    return named.join(together, "pair").where(F.abs("corr") >= least).select("left", "right", "corr")
