"""Sources, sinks, catalogue, positions, shards, splits, batches and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.tables import FAM, LVL, PTS, big, columns, embeddings, long_matrix, long_vector, profiles, registry, rnd, sql_rnd, table
from gridframe.functions import permute
from gridframe.functions.draws import hash_key
from gridframe.operators import align, batches, evaluate, index, moments, reshape, split
from gridframe.schema import COLUMNS, MATRIX, STATS, VECTOR
from gridframe.session import scratch_path
from gridframe.sources import buckets, catalog, shards, zones
from gridframe.sources import columns as source

QUERIES, SQL, query = registry()

SEED = 42


def _schema(kind, *extra: str) -> T.StructType:
    fields = [T.StructField("column_id", T.LongType()), T.StructField("x", kind), T.StructField("y", kind)]
    if kind is MATRIX:
        fields.append(T.StructField("edge", kind))
    return T.StructType(fields + [T.StructField(e, T.IntegerType()) for e in extra])


FLATTENED = _schema(VECTOR, "shard")
FEATURES = _schema(MATRIX, "shard")
ORDERS = "o_orderkey bigint, o_custkey bigint, o_totalprice double"


def _orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


# -- sources ---------------------------------------------------------------------------------------------------------


def _stored_columns(spark, sf) -> str:
    path = scratch_path(spark, "columns")
    columns(spark, sf).repartition("timestep", "patch").write.partitionBy("timestep", "patch").parquet(path)
    return path


@query("s1_load_columns", f"""WITH {FAM} SELECT column_id, i.timestep, i.patch, level, variable, v AS value FROM hl
  JOIN ids i USING (column_id) WHERE timestep IN (0, 1000, 2000, 3000) AND patch BETWEEN 0 AND 15""")
def _(spark, sf):
    df = source.load_columns(spark, _stored_columns(spark, sf), range(0, 3501, 1000), range(16), "2020-01-01")
    long = long_matrix(df, ["column_id", "timestep", "patch"], "hl_inputs")
    return long.withColumn("timestep", big("timestep")).withColumn("patch", big("patch"))


@query("s4_heating_units", f"""WITH {LVL} SELECT column_id, level AS pos, {sql_rnd('v * 86400', 3)} AS value FROM lvl
  WHERE variable = 0 AND level < 15""")
def _(spark, sf):
    df = source.load_columns(spark, _stored_columns(spark, sf), hr_units="K d-1")
    return long_vector(df, ["column_id"], "hr_sw", 3)


@query("s5_outputs_and_raw_inputs", f"""WITH {FAM}
  SELECT column_id, 'skin_temperature' AS name, CAST(0 AS BIGINT) AS pos, v AS value FROM sca WHERE pos = 0
  UNION ALL SELECT column_id, 'temperature_hl', level, v FROM hl WHERE variable = 0
  UNION ALL SELECT column_id, 're_liquid', level, v FROM col WHERE variable = 25
  UNION ALL SELECT column_id, 'flux_up_lw', level, v FROM flux WHERE variable = 3""")
def _(spark, sf):
    df = source.load_columns(spark, _stored_columns(spark, sf), minimal_outputs=True, raw_inputs=True)
    assert "hr_sw" not in df.columns
    parts = [F.struct(F.lit("skin_temperature").alias("name"), F.array("skin_temperature").alias("v"))]
    parts += [F.struct(F.lit(n).alias("name"), F.col(n).alias("v")) for n in ("temperature_hl", "re_liquid", "flux_up_lw")]
    return long_vector(df.select("column_id", F.inline(F.array(*parts))), ["column_id", "name"], "v")


@query("s6_load_batched", f"""WITH {PTS}, s AS (SELECT pos, avg(v) AS m, stddev_pop(v) AS d FROM pts GROUP BY pos),
  chosen AS (SELECT vec_id AS column_id, row_number() OVER (ORDER BY vec_id % 15 * 250, vec_id % 5, vec_id) - 1 AS position
    FROM embeddings WHERE vec_id % 15 * 250 IN (0, 500, 1000, 1500, 2000, 2500, 3000, 3500) AND vec_id % 5 IN (0, 1, 2, 3))
  SELECT column_id, position, position // 32 AS batch_id, pos, {sql_rnd('(v - m) / (d + 1e-8)')} AS value
  FROM chosen JOIN pts USING (column_id) JOIN s USING (pos)""")
def _(spark, sf):
    df = embeddings(spark, sf)
    stats = moments.position_moments(df, ["embedding"])
    keyed = df.withColumn("timestep", F.col("column_id") % 15 * 250).withColumn("filenum", F.col("column_id") % 5)
    batched = source.load_batched(keyed, "embedding", stats, range(0, 3501, 500), range(4), 32)
    return long_vector(batched, ["column_id", "position", "batch_id"], "embedding", 6)


@query("s8_read_shards", f"WITH {FAM} SELECT column_id, pos, v AS value FROM flat_x")
def _(spark, sf):
    path = scratch_path(spark, "flattened")
    shards.write_shards(reshape.flattened(columns(spark, sf)), path, 20, uneven=True)
    return long_vector(shards.read_shards(spark, path, ["x"], FLATTENED, ["column_id"]), ["column_id"], "x")


@query("s10_read_shard", f"""WITH {FAM}, n AS (SELECT count(*) // 20 AS size FROM embeddings)
  SELECT CAST(7 AS BIGINT) AS shard, column_id, pos, v AS value FROM flat_y, n WHERE column_id // size = 7""")
def _(spark, sf):
    path, listed = scratch_path(spark, "flattened"), scratch_path(spark, "catalog")
    shards.write_shards(reshape.flattened(columns(spark, sf)), path, 20, uneven=True)
    written = shards.read_shards(spark, path, ["x", "y"], FLATTENED, ["shard"])
    catalog.catalog_upsert(spark, listed, catalog.describe_table(written, 250, "flattened"))
    entry = catalog.entry_of(spark, listed, 250, "flattened")
    return long_vector(shards.read_shard(spark, path, 7, FLATTENED, entry), ["shard", "column_id"], "y")


@query("s11_read_rows", f"WITH {FAM} SELECT column_id, level, variable, v AS value FROM nodes_x WHERE column_id >= 100 AND column_id < 400")
def _(spark, sf):
    path = scratch_path(spark, "container")
    shards.write_container(reshape.features(columns(spark, sf)), path)
    return long_matrix(shards.read_rows(spark, path, 100, 400, _schema(MATRIX)), ["column_id"], "x")


@query("u1_union_parts", """SELECT 'customer' AS part, c_custkey AS key, c_acctbal AS balance FROM customer
  UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier""")
def _(spark, sf):
    parts = []
    for name, key, value in (("customer", "c_custkey", "c_acctbal"), ("supplier", "s_suppkey", "s_acctbal")):
        part = table(spark, sf, name).select(F.lit(name).alias("part"), F.col(key).alias("key"), F.col(value).alias("balance"))
        parts.append(part)
    return source.union_parts(parts)


@query("u1_read_parts", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, sf):
    paths = []
    for rest in range(2):
        paths.append(scratch_path(spark, "orders"))
        _orders(spark, sf).where(F.col("o_orderkey") % 2 == rest).write.parquet(paths[-1])
    return source.read_parts(spark, paths).select("o_orderkey", "o_custkey", "o_totalprice")


# -- sinks and catalogue ---------------------------------------------------------------------------------------------


@query("k1_write_shards", """SELECT o_orderkey // (SELECT count(*) // 10 FROM orders) AS shard, o_orderkey, o_custkey, o_totalprice
  FROM orders""")
def _(spark, sf):
    path = scratch_path(spark, "orders")
    shards.write_shards(_orders(spark, sf), path, 10, "o_orderkey")
    stored = shards.read_shards(spark, path, ["o_orderkey", "o_custkey", "o_totalprice"], _ddl(ORDERS + ", shard int"), ["shard"])
    return stored.withColumn("shard", big("shard"))


def _ddl(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


@query("k2_write_container", f"""WITH {FAM}
  SELECT 'x' AS part, column_id, level, variable, v AS value FROM nodes_x
  UNION ALL SELECT 'y', column_id, level, variable, v FROM flux
  UNION ALL SELECT 'edge', column_id, level, variable, v FROM col""")
def _(spark, sf):
    path = scratch_path(spark, "container")
    shards.write_container(reshape.features(columns(spark, sf)), path)
    stored = shards.read_shards(spark, path, ["x", "y", "edge"], _schema(MATRIX), ["column_id"])
    parts = F.inline(F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).alias("m")) for p in ("x", "y", "edge")]))
    return long_matrix(stored.select("column_id", parts), ["part", "column_id"], "m")


@query("k4_reshard", """WITH n AS (SELECT CAST(ceil(count(*) / 20.0) AS BIGINT) AS size FROM orders)
  SELECT o_orderkey // size // 5 AS rank, o_orderkey // size AS shard, o_orderkey, o_custkey, o_totalprice FROM orders, n""")
def _(spark, sf):
    container, path = scratch_path(spark, "container"), scratch_path(spark, "pieces")
    orders = _orders(spark, sf)
    shards.write_container(orders, container, "o_orderkey")
    stored = spark.read.schema(_ddl(ORDERS)).parquet(container)
    size = -(-stored.count() // 20)
    shards.reshard(stored, path, ranks=4, files_per_rank=5, rows_per_file=size, row_id="o_orderkey")
    pieces = spark.read.schema(_ddl(ORDERS + ", rank int, shard int")).parquet(path)
    return pieces.withColumn("rank", big("rank")).withColumn("shard", big("shard"))


@query("k5_overwrite", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, sf):
    path = scratch_path(spark, "orders")
    for _ in range(2):
        shards.write_shards(_orders(spark, sf), path, 5, "o_orderkey", mode="overwrite")
    return shards.read_shards(spark, path, ["o_orderkey", "o_custkey", "o_totalprice"], _ddl(ORDERS))


@query("k6_save_stats", f"""WITH {PTS} SELECT 'embedding' AS "array", pos, count(*) AS n, {sql_rnd('avg(v)')} AS mean,
  {sql_rnd('stddev_pop(v)')} AS std FROM pts GROUP BY pos""")
def _(spark, sf):
    path = scratch_path(spark, "stats")
    catalog.save_stats(moments.position_moments(embeddings(spark, sf), ["embedding"]), path)
    stored = catalog.load_stats(spark, path, ["embedding"])
    return stored.select("array", big("pos"), "n", rnd(F.col("mean")).alias("mean"), rnd(F.col("std")).alias("std"))


def _described(spark, sf, kind):
    shape = {"features": reshape.features, "flattened": reshape.flattened}[kind]
    df = shape(columns(spark, sf))
    return catalog.describe_table(index.with_shard(df, "column_id", 25), 250, kind)


def _entry(df):
    shapes = []
    for name in ("x", "y", "edge"):
        axes = [F.get(F.col(f"{name}_shape"), F.lit(i)) for i in (0, 1)]
        shapes += [F.coalesce(axis, F.lit(0)).cast("bigint").alias(f"{name}_{i}") for i, axis in enumerate(axes)]
    return df.select(big("step"), "kind", "dtype", "dataset_len", "num_shards", *shapes)


_SHAPES = """(VALUES ('flattened', 468, 0, 64, 0, 0, 0), ('features', 16, 20, 16, 4, 15, 27))
  t(kind, x_0, x_1, y_0, y_1, edge_0, edge_1)"""
_AXES = ", ".join(f"CAST({axis} AS BIGINT) AS {axis}" for axis in ("x_0", "x_1", "y_0", "y_1", "edge_0", "edge_1"))
_ENTRY = f"""SELECT CAST(250 AS BIGINT) AS step, kind, 'float32' AS dtype, dataset_len, num_shards, {_AXES}
  FROM {_SHAPES}, (SELECT count(*) AS dataset_len, count(DISTINCT vec_id // 25) AS num_shards FROM embeddings)"""


@query("k8_catalog_upsert", _ENTRY)
def _(spark, sf):
    path = scratch_path(spark, "catalog")
    for kind in ("flattened", "features", "flattened"):
        catalog.catalog_upsert(spark, path, _described(spark, sf, kind))
    return _entry(catalog.read_catalog(spark, path))


@query("k9_catalog_get", _ENTRY + " WHERE kind = 'features'")
def _(spark, sf):
    path = scratch_path(spark, "catalog")
    both = _described(spark, sf, "flattened").unionByName(_described(spark, sf, "features"))
    catalog.catalog_upsert(spark, path, both)
    return _entry(catalog.catalog_get(spark, path, 250, "features"))


@query("k10_describe_table", _ENTRY)
def _(spark, sf):
    return _entry(_described(spark, sf, "flattened").unionByName(_described(spark, sf, "features")))


# -- positions and shards --------------------------------------------------------------------------------------------


@query("h1_plan_shards", """WITH sizes AS (SELECT 'orders' AS name, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events
    UNION ALL SELECT 'part', count(*) FROM part),
  divisors AS (SELECT name, n_rows, unnest(range(1, n_rows + 1)) AS d FROM sizes)
  SELECT name, n_rows, d AS num_shards, n_rows // d AS shard_size FROM divisors WHERE n_rows % d = 0
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY abs(d - 64), d) = 1""")
def _(spark, sf):
    sizes = [table(spark, sf, t).agg(F.lit(t).alias("name"), F.count("*").alias("n_rows")) for t in ("orders", "lineitem", "events", "part")]
    return index.plan_shards(source.union_parts(sizes), 64)


@query("h2_rechunk_rows", """WITH n AS (SELECT count(*) // 12 AS size FROM orders)
  SELECT o_orderkey // size AS shard, count(*) AS n_rows, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id,
    CAST(1 AS BIGINT) AS n_tasks FROM orders, n GROUP BY 1""")
def _(spark, sf):
    orders = _orders(spark, sf)
    size = orders.count() // 12
    chunks = index.rechunk_rows(orders, "o_orderkey", size, 12).withColumn("task", F.spark_partition_id())
    report = chunks.groupBy("shard").agg(
        F.count("*").alias("n_rows"), F.min("o_orderkey").alias("first_id"), F.max("o_orderkey").alias("last_id"),
        F.count_distinct("task").alias("n_tasks"),
    )
    return report.withColumn("shard", big("shard"))


@query("x1_with_row_id", "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS row_id FROM orders")
def _(spark, sf):
    orders = _orders(spark, sf).select("o_orderkey", "o_totalprice")
    return index.with_row_id(orders, [F.desc("o_totalprice"), "o_orderkey"])


@query("x1_group_position", """SELECT user_id, event_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS position FROM events""")
def _(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return index.with_group_position(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("x1_group_position_nulls", """SELECT nullif(user_id % 7, 0) AS grp, event_id,
  row_number() OVER (PARTITION BY nullif(user_id % 7, 0) ORDER BY ts, event_id) - 1 AS position FROM events""")
def _(spark, sf):
    events = table(spark, sf, "events").select(F.nullif(F.col("user_id") % 7, F.lit(0)).alias("grp"), "event_id", "ts")
    return index.with_group_position(events, ["grp"], ["ts", "event_id"]).drop("ts")


@query("x1_file_position", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders")
def _(spark, sf):
    return index.with_file_position(table(spark, sf, "orders")).select("o_orderkey", "row_id")


@query("x2_locate", "SELECT o_orderkey, o_orderkey // 320 AS shard, o_orderkey % 320 AS row_in_shard FROM orders")
def _(spark, sf):
    shard, row = index.locate("o_orderkey", 320)
    return _orders(spark, sf).select("o_orderkey", shard.alias("shard"), row.alias("row_in_shard"))


@query("x2_fetch_rows", """SELECT o_orderkey, o_custkey, o_totalprice, o_orderkey // 320 AS shard, o_orderkey % 320 AS row_in_shard
  FROM orders WHERE o_orderkey IN (SELECT c_custkey * 7 FROM customer)""")
def _(spark, sf):
    wanted = table(spark, sf, "customer").select((F.col("c_custkey") * 7).alias("o_orderkey"))
    stored = index.with_shard(_orders(spark, sf), "o_orderkey", 320)
    return index.fetch_rows(stored, wanted, "o_orderkey", 320).withColumn("shard", big("shard"))


@query("x2_fetch_indexed", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT c_custkey * 7 FROM customer WHERE c_custkey % 9 = 0)")
def _(spark, sf):
    """Orders in files of consecutive ids; only files with a wanted id are opened."""
    path, zoned = scratch_path(spark, "indexed"), scratch_path(spark, "zones")
    orders = _orders(spark, sf)
    zones.write_indexed(orders.repartitionByRange(16, "o_orderkey").sortWithinPartitions("o_orderkey"), path, zoned, "o_orderkey")
    wanted = table(spark, sf, "customer").where("c_custkey % 9 = 0").select((F.col("c_custkey") * 7).alias("o_orderkey"))
    return zones.fetch_indexed(spark, path, zoned, wanted, "o_orderkey", orders.schema)


_HASH = "md5('42-' || o_orderkey)"


@query("t1_shuffle_rows", f"SELECT o_orderkey, row_number() OVER (ORDER BY {_HASH}, o_orderkey) - 1 AS position FROM orders")
def _(spark, sf):
    return index.shuffle_rows(_orders(spark, sf).select("o_orderkey"), "o_orderkey", SEED)


def _split_sql(first: str, second: str) -> str:
    return f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {_HASH}, o_orderkey) - 1 AS p FROM orders),
  n AS (SELECT count(*) AS n FROM orders), b AS (SELECT {first} AS a, {second} AS z FROM n)
  SELECT o_orderkey, CASE WHEN p < a THEN 'train' WHEN p < z THEN 'val' ELSE 'test' END AS split FROM r, b"""


_TENTHS = [f"floor(n * CAST({f} AS DOUBLE))" for f in ("0.8", "0.1", "0.9")]


@query("l1_random_split", _split_sql(_TENTHS[0], f"{_TENTHS[0]} + {_TENTHS[1]}"))
def _(spark, sf):
    return split.random_split(_orders(spark, sf).select("o_orderkey"), "o_orderkey", SEED)


@query("l2_shuffled_slices", _split_sql(_TENTHS[0], _TENTHS[2]))
def _(spark, sf):
    return split.shuffled_slices(_orders(spark, sf).select("o_orderkey"), "o_orderkey", SEED)


@query("l3_head_holdout", """SELECT o_orderkey, o_orderkey // 64 AS batch_id,
  CASE WHEN o_orderkey // 64 < 500 // 64 THEN 'val' ELSE 'train' END AS split FROM orders""")
def _(spark, sf):
    return batches.with_head_holdout(_orders(spark, sf).select("o_orderkey"), "o_orderkey", 500, 64)


@query("b1_batches", "SELECT o_orderkey // 256 AS batch_id, count(*) AS n_rows, min(o_orderkey) AS first_id FROM orders GROUP BY 1")
def _(spark, sf):
    batched = batches.batches(_orders(spark, sf), "o_orderkey", 256)
    return batched.groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.min("o_orderkey").alias("first_id"))


@query("b2_shuffled_batches", f"""SELECT o_orderkey, shuffled, shuffled // 256 AS batch_id FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY {_HASH}, o_orderkey) - 1 AS shuffled FROM orders)""")
def _(spark, sf):
    return batches.batches(_orders(spark, sf).select("o_orderkey"), "o_orderkey", 256, shuffle=True, seed=SEED)


def _permuted_sql(source: str, key: str, seed: int, epoch: int) -> str:
    """Places of an epoch by the same arithmetic: a pass at a time until the number is below n."""
    mixed = "xor(h3, h3 >> 16)"
    rounds = ["r0 AS (SELECT id, spot // w AS x, spot % w AS y, (n + w - 1) // w AS a, w AS b, n, w FROM walk WHERE NOT done)"]
    for r, k in enumerate(permute.round_keys(seed, epoch)):
        low, factor = "4294967295", permute.FACTOR
        rounds.append(f"""h{r} AS (SELECT *, (((y + {k}) & {low}) * {factor}) & {low} AS h1 FROM r{r}),
  g{r} AS (SELECT *, (xor(h1, h1 >> 16) * {factor}) & {low} AS h3 FROM h{r}),
  r{r + 1} AS (SELECT id, y AS x, (x + {mixed}) % a AS y, b AS a, a AS b, n, w FROM g{r})""")
    chain = ", ".join(rounds)
    return f"""WITH RECURSIVE side AS (SELECT count(*) AS n, CAST(floor(sqrt(count(*) - 1)) AS BIGINT) + 1 AS w FROM {source}),
  walk AS (SELECT {key} AS id, {key} AS spot, n, w, false AS done FROM {source}, side UNION ALL
    (WITH {chain} SELECT id, x * w + y, n, w, x * w + y < n FROM r{len(rounds) - 1}))
  SELECT id, spot FROM walk WHERE done"""


@query("b2_epoch_batches", " UNION ALL ".join(f"""SELECT {e} AS epoch, id AS o_orderkey, spot AS shuffled, spot // 256 AS batch_id FROM (
  {_permuted_sql('orders', 'o_orderkey', SEED, e)})""" for e in range(3)))
def _(spark, sf):
    """Three epochs over the same rows, each in an order of its own."""
    orders = _orders(spark, sf).select("o_orderkey")
    n = orders.count()
    epochs = [batches.epoch_batches(orders, "o_orderkey", 256, SEED, e, n).withColumn("epoch", F.lit(e)) for e in range(3)]
    return epochs[0].unionByName(epochs[1]).unionByName(epochs[2])


@query("b3_rank_batches", "SELECT o_orderkey, o_orderkey % 6 AS rank, o_orderkey // 6 // (512 // 6) AS batch_id FROM orders")
def _(spark, sf):
    return batches.rank_batches(_orders(spark, sf).select("o_orderkey"), "o_orderkey", 512, 6)


@query("b4_head_tail_batches", """SELECT CASE WHEN o_orderkey // 64 < 500 // 64 THEN 'val' ELSE 'train' END AS part,
  o_orderkey // 64 AS batch_id, count(*) AS n_rows FROM orders GROUP BY ALL""")
def _(spark, sf):
    val, train = batches.head_tail_batches(_orders(spark, sf), "o_orderkey", 500, 64)
    both = val.withColumn("part", F.lit("val")).unionByName(train.withColumn("part", F.lit("train")))
    return both.groupBy("part", "batch_id").agg(F.count("*").alias("n_rows"))


@query("t2_take_skip", """SELECT o_orderkey, CASE WHEN o_orderkey // 100 < 5 THEN 'taken' ELSE 'rest' END AS part FROM orders""")
def _(spark, sf):
    batched = batches.batches(_orders(spark, sf).select("o_orderkey"), "o_orderkey", 100)
    taken = batches.take_batches(batched, 5).withColumn("part", F.lit("taken"))
    return taken.unionByName(batches.skip_batches(batched, 5).withColumn("part", F.lit("rest"))).drop("batch_id")


@query("j1_zip_arrays", f"""WITH {FAM}, a AS (SELECT column_id, sum(v) AS x FROM flat_x GROUP BY 1),
  b AS (SELECT column_id, sum(v) AS y FROM flat_y GROUP BY 1), c AS (SELECT column_id, sum(v) AS edge FROM col GROUP BY 1)
  SELECT column_id, {sql_rnd('x')} AS x, {sql_rnd('y')} AS y, {sql_rnd('edge')} AS edge FROM a JOIN b USING (column_id) JOIN c USING (column_id)""")
def _(spark, sf):
    records = columns(spark, sf)
    flat, feats = reshape.flattened(records), reshape.features(records)
    zipped = align.zip_arrays(flat.select("column_id", "x"), flat.select("column_id", "y"), feats.select("column_id", "edge"))

    def total(vector):
        return rnd(F.aggregate(vector, F.lit(0.0), lambda s, v: s + v))

    return zipped.select("column_id", total("x").alias("x"), total("y").alias("y"), total(F.flatten("edge")).alias("edge"))


@query("j1_zip_buckets", SQL["j1_zip_arrays"])
def _(spark, sf):
    """The same from tables stored in buckets of the position."""
    records = columns(spark, sf)
    flat, feats = reshape.flattened(records), reshape.features(records)
    names, stored = [], {"x": flat.select("column_id", "x"), "y": flat.select("column_id", "y"), "edge": feats.select("column_id", "edge")}
    for array, df in stored.items():
        path = scratch_path(spark, f"buckets_{array}")
        names.append(path.rpartition("/")[2].replace("-", "_"))
        buckets.write_buckets(df, names[-1], path, 8)

    def total(vector):
        return rnd(F.aggregate(vector, F.lit(0.0), lambda s, v: s + v))

    zipped = align.zip_buckets(spark, names)
    return zipped.select("column_id", total("x").alias("x"), total("y").alias("y"), total(F.flatten("edge")).alias("edge"))


# -- evaluation ------------------------------------------------------------------------------------------------------


def _predicted(spark, sf):
    """Profile b predicted as 0.5 a + 0.1, and d as -c, with a stage and a batch for each record."""
    df = profiles(spark, sf)
    half = F.transform("a", lambda v: v.cast("double") * 0.5 + 0.1)
    minus = F.transform("c", lambda v: -v.cast("double"))
    df = df.select("*", half.alias("b_hat"), minus.alias("d_hat"))
    stage = F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), (F.col("label") % 3 + 1).cast("int"))
    return batches.batches(df.withColumn("stage", stage), "column_id", 32)


_GAPS = LVL + """, w AS (SELECT column_id, level, max(label) AS label, max(v) FILTER (variable = 0) AS a, max(v) FILTER (variable = 1) AS b,
    max(v) FILTER (variable = 2) AS c, max(v) FILTER (variable = 3) AS d FROM lvl GROUP BY ALL),
  g AS (SELECT column_id, label, a * CAST(0.5 AS DOUBLE) + CAST(0.1 AS DOUBLE) - b AS gb, -c - d AS gd FROM w)"""


@query("a9_mse", f"WITH {_GAPS} SELECT count(*) AS n, {sql_rnd('avg(gb * gb)')} AS mse FROM g")
def _(spark, sf):
    return evaluate.mse(_predicted(spark, sf), "b_hat", "b").withColumn("mse", rnd(F.col("mse")))


_PAIRS = {"sw": ("b_hat", "b"), "lw": ("d_hat", "d")}


@query("a10_weighted_mse", f"""WITH {_GAPS}, m AS (SELECT avg(gb * gb) AS s, avg(gd * gd) AS l FROM g)
  SELECT {sql_rnd('s')} AS mse_sw, {sql_rnd('l')} AS mse_lw, {sql_rnd('s * 2 + l')} AS loss FROM m""")
def _(spark, sf):
    out = evaluate.weighted_mse(_predicted(spark, sf), _PAIRS, {"sw": 2.0})
    return out.select(*[rnd(F.col(c)).alias(c) for c in out.columns])


@query("a11_mae", f"""WITH {_GAPS} SELECT 'sw' AS output, {sql_rnd('avg(abs(gb))')} AS mae FROM g
  UNION ALL SELECT 'lw', {sql_rnd('avg(abs(gd))')} FROM g""")
def _(spark, sf):
    return evaluate.mae(_predicted(spark, sf), _PAIRS).withColumn("mae", rnd(F.col("mae")))


_STAGES = _GAPS + """, t AS (SELECT ['train', 'val', 'test'][label % 3 + 1] AS stage, column_id // 32 AS batch_id,
    avg(gb * gb) AS loss, count(DISTINCT column_id) AS n_rows FROM g GROUP BY ALL)"""


@query("a12_stage_metrics", f"WITH {_STAGES} SELECT stage, batch_id, n_rows, {sql_rnd('loss')} AS loss FROM t")
def _(spark, sf):
    return evaluate.stage_metrics(_predicted(spark, sf), "stage", "batch_id", "b_hat", "b").withColumn("loss", rnd(F.col("loss")))


@query("a12_epoch_metrics", f"""WITH {_STAGES} SELECT stage, CAST(sum(n_rows) AS BIGINT) AS n_rows,
  {sql_rnd('sum(loss * n_rows) / sum(n_rows)')} AS loss FROM t GROUP BY stage""")
def _(spark, sf):
    per_batch = evaluate.stage_metrics(_predicted(spark, sf), "stage", "batch_id", "b_hat", "b")
    return evaluate.epoch_metrics(per_batch, "stage").withColumn("loss", rnd(F.col("loss")))
