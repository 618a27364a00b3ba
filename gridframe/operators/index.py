"""Dense positions, shards and reproducible orders.

No step here sends all rows, or all rows of one hot group, to a single task: positions come from a range-partitioned
sort plus one offset per partition, or from hash buckets of equal expected size plus one offset per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridframe.functions.arrays import int_div
from gridframe.functions.draws import hash_key
from gridframe.session import cut


def with_row_id(df: DataFrame, order_by: Sequence[str | Column], name: str = "row_id") -> DataFrame:
    """Dense position 0..n-1 in the given order, which must be total (end it with a unique column).

    The sort range-partitions on all order columns, so a hot leading value is split by the later ones. The sorted
    rows are written once; one offset per partition (as many as there are shuffle partitions) is then broadcast.
    """
    placed = _in_order(df, order_by)
    return placed.join(F.broadcast(_part_starts(placed)), "_part").select(*df.columns, (F.col("_start") + F.col("_at")).alias(name))


def _in_order(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """Rows range-sorted and written once, with the partition ``_part`` and the place ``_at`` in it."""
    ordered = cut(df.orderBy(*order_by).withColumn("_seq", F.monotonically_increasing_id()))
    at = F.col("_seq").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.select(*df.columns, F.shiftright("_seq", 33).alias("_part"), at.alias("_at"))


def _part_starts(placed: DataFrame) -> DataFrame:
    """Rows before each partition."""
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    return sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_start"))


def with_group_position(
    df: DataFrame, group: Sequence[str], order_by: Sequence[str | Column], name: str = "position"
) -> DataFrame:
    """Dense position 0..k-1 inside each group, also where one group holds a large part of all rows.

    Null keys form groups like any others.
    """
    placed = _in_order(df, [*group, *order_by])
    key = F.struct(*[F.col(g) for g in group])
    starts = _part_starts(placed)
    # Where a group begins inside each partition; partitions split a hot group, and no join is on the group.
    here = placed.withColumn("_from", F.min("_at").over(W.partitionBy("_part", *group)))
    ends = placed.groupBy("_part").agg(
        F.min_by(key, "_at").alias("_head"), F.max_by(key, "_at").alias("_tail"), F.min("_at").alias("_low")
    )
    tail = here.groupBy("_part").agg(F.max("_from").alias("_tail_from"))
    ends = ends.join(tail, "_part").join(F.broadcast(starts), "_part")
    # A group that crosses partitions begins where it first is the tail or the head of one: two rows per partition.
    edges = F.explode(
        F.array(
            F.struct(F.col("_head").alias("_g"), (F.col("_start") + F.col("_low")).alias("_first")),
            F.struct(F.col("_tail").alias("_g"), (F.col("_start") + F.col("_tail_from")).alias("_first")),
        )
    )
    first = ends.select(edges.alias("e")).groupBy("e._g").agg(F.min("e._first").alias("_first"))
    heads = ends.select("_part", "_start", "_head").join(F.broadcast(first), F.col("_head").eqNullSafe(F.col("_g")))
    out = here.join(F.broadcast(heads.select("_part", "_start", "_head", "_first")), "_part")
    begins = F.when(key.eqNullSafe(F.col("_head")), F.col("_first")).otherwise(F.col("_start") + F.col("_from"))
    return out.select(*df.columns, (F.col("_start") + F.col("_at") - begins).alias(name))


def with_file_position(df: DataFrame, name: str = "row_id", order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Dense position of rows as they lie in the files: by ``order_by``, then files by path, then row by row.

    ``df`` must come straight from a Parquet read. ``order_by`` are partition columns, or expressions over them: paths
    compare as text, where 1000 comes before 250. Rows are not sorted, and nothing is shuffled for the counts but one
    row per file; how the counts meet the rows is left to the planner.
    """
    at = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    keys = [(F.col(c) if isinstance(c, str) else c).alias(f"_k{i}") for i, c in enumerate(order_by)]
    sizes = at.groupBy(*keys, "_file").agg(F.count("*").alias("_n"))
    order = W.orderBy(*[f"_k{i}" for i in range(len(keys))], "_file")
    starts = sizes.select("_file", (F.sum("_n").over(order) - F.col("_n")).alias("_start"))
    return at.join(starts, "_file").select(*df.columns, (F.col("_start") + F.col("_at")).alias(name))


def _bucket_starts(keys: DataFrame, digits: int) -> DataFrame:
    """Rows before each hash bucket, and in total; at most 16**digits rows."""
    sizes = keys.groupBy(F.substring("_h", 1, digits).alias("_b")).agg(F.count("*").alias("_n"))
    return sizes.select(
        "_b",
        "_n",
        (F.sum("_n").over(W.orderBy("_b")) - F.col("_n")).alias("_start"),
        F.sum("_n").over(W.partitionBy()).alias("_total"),
    )


def shuffle_rows(df: DataFrame, row_id: str, seed, name: str = "position", parts: int | None = None) -> DataFrame:
    """Random permutation fixed by the seed: every row gets its dense position in hash order.

    ``row_id`` is unique, so equal ranges of the hash hold nearly equal numbers of rows: one task ranks each range, and
    the rows lie in the new order afterwards. Rows are moved once.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = hash_key(row_id, seed)
    part = F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("double") / 4294967296.0 * parts).cast("int")
    sizes = df.select(key.alias("_h")).groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_start"))
    placed = df.withColumn("_h", key).withColumn("_part", part).repartitionById(parts, F.col("_part"))
    rank = F.row_number().over(W.partitionBy("_part").orderBy("_h", row_id))
    return (
        placed.withColumn("_rank", rank)
        .join(F.broadcast(starts), "_part")
        .select(*df.columns, (F.col("_start") + F.col("_rank") - 1).cast("bigint").alias(name))
    )


def hash_order_cuts(df: DataFrame, row_id: str, seed, bounds: dict[str, Column], digits: int = 4) -> DataFrame:
    """One row: for each bound the hash key of the row standing at that position of the shuffled order.

    A bound is an expression over ``_total``. Only ids are read, and only the few buckets that hold a bound are
    ranked, so wide rows are never moved to be split.
    """
    keys = df.select(hash_key(row_id, seed).alias("_h"))
    marks = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), b.cast("bigint").alias("at")) for k, b in bounds.items()]))
    wanted = (
        _bucket_starts(keys, digits)
        .select("*", marks.alias("_mark"))
        .where((F.col("_mark.at") >= F.col("_start")) & (F.col("_mark.at") < F.col("_start") + F.col("_n")))
        .select("_b", F.col("_mark.k").alias("_k"), (F.col("_mark.at") - F.col("_start")).alias("_at"))
    )
    ranked = (
        keys.withColumn("_b", F.substring("_h", 1, digits))
        .join(F.broadcast(wanted), "_b")
        .withColumn("_rank", F.row_number().over(W.partitionBy("_k").orderBy("_h")) - 1)
        .where(F.col("_rank") == F.col("_at"))
    )
    return ranked.agg(*[F.max(F.when(F.col("_k") == k, F.col("_h"))).alias(k) for k in bounds])


def locate(row_id: str | Column, shard_size: int | Column) -> tuple[Column, Column]:
    """Shard number and row inside the shard of a dense position."""
    row_id = F.col(row_id) if isinstance(row_id, str) else row_id
    return int_div(row_id, shard_size), (row_id % shard_size).cast("bigint")


def with_shard(df: DataFrame, row_id: str, shard_size: int) -> DataFrame:
    shard, _ = locate(row_id, shard_size)
    return df.withColumn("shard", shard.cast("int"))


def fetch_rows(df: DataFrame, ids: DataFrame, row_id: str, shard_size: int) -> DataFrame:
    """Rows at the wanted positions, with their place; ``df`` carries ``shard`` and ``row_id``.

    The join is on the shard as well, so partitions without a wanted row are skipped when the ids are few.
    """
    wanted = with_shard(ids.select(row_id).distinct(), row_id, shard_size)
    _, within = locate(row_id, shard_size)
    return df.join(wanted, ["shard", row_id], "left_semi").withColumn("row_in_shard", within)


def plan_shards(sizes: DataFrame, target: int, n_rows: str = "n_rows") -> DataFrame:
    """The divisor of each row count nearest to the wanted shard count (the smaller one when two are as near)."""
    n = F.col(n_rows)
    low = F.explode(F.sequence(F.lit(1).cast("bigint"), F.floor(F.sqrt(n.cast("double"))).cast("bigint")))
    divisors = (
        sizes.where(n > 0)
        .withColumn("_d", low)
        .where(n % F.col("_d") == 0)
        .withColumn("_d", F.explode(F.array(F.col("_d"), int_div(n, F.col("_d")))))
    )
    nearest = F.min_by("_d", F.struct(F.abs(F.col("_d") - target), F.col("_d")))
    return (
        divisors.groupBy(*sizes.columns)
        .agg(nearest.alias("num_shards"))
        .withColumn("shard_size", int_div(n, F.col("num_shards")))
    )


def rechunk_rows(df: DataFrame, row_id: str, shard_size: int, num_shards: int, tasks_per_shard: int = 1) -> DataFrame:
    """Whole rows laid out so that a task holds one shard, or an equal range of rows of one, in row order.

    A row beyond the last shard fails the job.
    """
    shard, within = locate(row_id, shard_size)
    beyond = F.raise_error(F.concat(F.lit(f"{num_shards} shards of {shard_size} rows have no place for row "), F.col(row_id)))
    shard = F.when(shard < num_shards, shard).otherwise(beyond.cast("bigint"))
    share = -(-shard_size // tasks_per_shard)
    task = shard * tasks_per_shard + int_div(within, share)
    placed = df.withColumn("shard", shard.cast("int")).withColumn("_task", task.cast("int"))
    laid_out = placed.repartitionById(num_shards * tasks_per_shard, F.col("_task"))
    return laid_out.drop("_task").sortWithinPartitions("shard", row_id)
