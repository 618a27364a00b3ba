"""Approximate nearest neighbours by a permutation index: pivot inverted files, footrule ranking, exact reranking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """False for vectors that are null, empty, zero, or hold null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def choose_pivots(vectors: DataFrame, pivots: int = 256, vec_id: str = "vec_id", vector: str = "embedding") -> np.ndarray:
    """At most ``pivots`` distinct vectors, by a hash of their id: the bounded sample the index is fitted on.

    Twice as many rows are fetched, since equal vectors make one pivot.
    """
    order = F.xxhash64(F.col(vec_id).cast("string"))
    rows = vectors.where(usable(F.col(vector))).orderBy(order, F.col(vec_id)).limit(2 * pivots).select(vector).collect()
    seen = dict.fromkeys(tuple(r[0]) for r in rows)
    if len({len(x) for x in seen}) > 1:
        raise ValueError("vectors must all have the same number of components")
    return np.array(list(seen)[:pivots], dtype="float64")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of one width as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    if len(flat) != len(column) * width:
        raise ValueError(f"vectors must all have {width} components")
    return flat.reshape(len(column), width)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.maximum(squares, 0)


def _orders(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each row, nearest first, ties to the smaller pivot."""
    return np.argsort(_distances(x, pivots), axis=1, kind="stable")[:, :prefix]


def _footrule(queries: np.ndarray, rows: np.ndarray, pivots: int) -> np.ndarray:
    """Footrule distance of every query to every row, summed from the posting lists of the query's pivots.

    A pivot absent from one of the two prefixes has the rank ``prefix`` there; what both sides lack costs nothing.
    """
    prefix = rows.shape[1]
    flat, place = rows.ravel(), np.tile(np.arange(prefix), len(rows))
    by_pivot = np.argsort(flat, kind="stable")
    ends = np.searchsorted(flat[by_pivot], np.arange(pivots + 1))
    row_of, place = by_pivot // prefix, place[by_pivot]
    # Nothing shared: every pivot of both prefixes is misplaced by prefix - rank.
    total = np.full((len(queries), len(rows)), prefix * (prefix + 1), dtype="int32")
    for q, order in enumerate(queries):
        for rank, pivot in enumerate(order):
            posting = slice(ends[pivot], ends[pivot + 1])
            there = place[posting]
            total[q, row_of[posting]] += np.abs(rank - there) - (prefix - rank) - (prefix - there)
    return total


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    pivots: int = 256,
    prefix: int = 64,
    share: float = 0.15,
    block: int = 512,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its ``k`` nearest found rows by Euclidean distance.

    Each vector is its ordered ``prefix`` nearest of ``pivots`` pivots. A task posts the vectors of each Arrow batch in
    one inverted file per pivot, ranks them for each query by footrule distance, and reranks the best ``share`` of
    them (``4 * k`` at least, and every row that ties with the last) by exact distance in double precision; its best
    ``k`` go to a merge by query, so a task sends ``k`` rows per batch and query whatever it reads. Queries are handled in blocks of
    ``block`` rows, a bounded closure each; blocks are formed by a hash, and the table is scanned once per block. All
    rows are indexed. A row is no neighbour of its own id. Ties go to the smaller id. Null, zero and non-finite
    vectors take no part; null ids neither; equal rows with one id count once. Vectors of different widths raise an error.
    Without vectors or queries the result is empty.
    """
    spark = vectors.sparkSession
    clean = lambda df: df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("embedding")).where(
        F.col("vec_id").isNotNull() & usable(F.col("embedding"))
    )
    rows, asked = clean(vectors), clean(queries).dropDuplicates(["vec_id"])
    schema = "query_id long, vec_id long, score double"
    fitted = choose_pivots(rows, pivots, "vec_id", "embedding")
    if not len(fitted):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    prefix = min(prefix, len(fitted))
    n_blocks = max(1, -(-asked.count() // block))
    found = None
    for b in range(n_blocks):
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b).toArrow()
        ids = part["vec_id"].to_numpy()
        if not len(ids):
            continue
        targets = _matrix(part["embedding"].combine_chunks(), fitted.shape[1])
        hits = rows.mapInArrow(_scan(ids, targets, fitted, prefix, share, k), schema)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = F.slice(F.array_sort(F.collect_set(F.struct("score", "vec_id"))), 1, k)
    merged = found.groupBy("query_id").agg(best.alias("best"))
    ranked = merged.select("query_id", F.posexplode("best").alias("rank", "hit"))
    return ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def _scan(ids, targets, fitted, prefix, share, k):
    """Search of one block of queries through the rows of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _orders(targets, fitted, prefix)
        for batch in batches:
            row_ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            if not len(row_ids):
                continue
            order = np.argsort(row_ids, kind="stable")
            order = order[np.r_[True, np.diff(row_ids[order]) != 0]]
            x = _matrix(batch.column("embedding"), fitted.shape[1])[order]
            row_ids = row_ids[order]
            keep = min(len(row_ids), max(4 * k, int(np.ceil(share * len(row_ids)))))
            far = _footrule(wanted, _orders(x, fitted, prefix), len(fitted))
            cut = np.partition(far, keep - 1, axis=1)[:, keep - 1]
            out = []
            for q in range(len(ids)):
                near = np.flatnonzero((far[q] <= cut[q]) & (row_ids != ids[q]))
                score = np.sqrt(((x[near] - targets[q]) ** 2).sum(1))
                top = np.lexsort((row_ids[near], score))[:k]
                out.append((np.full(len(top), ids[q]), row_ids[near][top], score[top]))
            columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    return run
