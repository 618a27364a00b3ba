"""Path graphs, graph batches and attention."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from checks.tables import FAM, LEVELS, LVL, big, columns, embeddings, profiles, registry, rnd, sql_rnd
from gridframe.functions.arrays import node_targets
from gridframe.operators import attention, pathgraph, reshape
from gridframe.operators.index import with_shard
from gridframe.session import scratch_path
from gridframe.sources import shards

QUERIES, SQL, query = registry()

ID = ["column_id"]


# Directed edges of the 16-level path, with the layer each runs through.
_TEMPLATE = """tpl AS (SELECT i + 1 AS src, i AS dst, i AS layer FROM range(15) r(i)
    UNION ALL SELECT i, i + 1, i FROM range(15) r(i))"""


@query("g1_path_edges", f"WITH {_TEMPLATE} SELECT vec_id AS column_id, src, dst FROM embeddings, tpl")
def _(spark, sf):
    return pathgraph.path_edges(profiles(spark, sf), ID, F.size("m"))


@query("u2_both_ways", """SELECT o_orderkey AS src, o_custkey AS dst FROM orders UNION ALL SELECT o_custkey, o_orderkey FROM orders""")
def _(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    return pathgraph.both_ways(orders.select(F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst")))


@query("j3_attach_edges", f"WITH {_TEMPLATE} SELECT vec_id AS column_id, src, dst, layer FROM embeddings, tpl")
def _(spark, sf):
    return pathgraph.attach_edges(embeddings(spark, sf), ID, LEVELS).withColumn("layer", big("layer"))


def _features(spark, sf):
    return reshape.features(columns(spark, sf))


@query("g2_build_graphs_nodes", f"""WITH {FAM} SELECT column_id, level AS node, 'x' AS part, variable, v AS value FROM nodes_x
  UNION ALL SELECT column_id, level, 'y', variable, v FROM flux""")
def _(spark, sf):
    nodes, _ = pathgraph.build_graphs(_features(spark, sf))
    parts = F.inline(F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).alias("v")) for p in ("x", "y")]))
    long = nodes.select("column_id", "node", parts).select("column_id", "node", "part", F.posexplode("v").alias("variable", "value"))
    return long.withColumn("variable", big("variable")).withColumn("value", F.col("value").cast("double"))


@query("g2_build_graphs_edges", f"""WITH {FAM}, {_TEMPLATE} SELECT column_id, src, dst, variable, v AS value
  FROM col JOIN tpl ON col.level = tpl.layer""")
def _(spark, sf):
    _, edges = pathgraph.build_graphs(_features(spark, sf))
    long = edges.select("column_id", "src", "dst", F.posexplode("attr").alias("variable", "value"))
    return long.withColumn("variable", big("variable")).withColumn("value", F.col("value").cast("double"))


@query("k7_write_graphs", f"""WITH {FAM}, {_TEMPLATE}, n AS (SELECT count(*) // 10 AS size FROM embeddings)
  SELECT 'nodes' AS part, column_id // size AS shard, column_id, level AS src, level AS dst, {sql_rnd('sum(v)')} AS total
    FROM nodes_x, n GROUP BY ALL
  UNION ALL SELECT 'edges', column_id // size, column_id, src, dst, {sql_rnd('sum(v)')}
    FROM col JOIN tpl ON col.level = tpl.layer, n GROUP BY ALL""")
def _(spark, sf):
    path = scratch_path(spark, "graphs")
    shards.write_graphs(_features(spark, sf), path, 10, uneven=True)

    def total(vector):
        return rnd(F.aggregate(vector, F.lit(0.0), lambda s, v: s + v)).alias("total")

    n = spark.read.parquet(f"{path}/nodes").select(
        F.lit("nodes").alias("part"), big("shard"), "column_id", F.col("node").alias("src"), F.col("node").alias("dst"), total("x")
    )
    e = spark.read.parquet(f"{path}/edges").select(F.lit("edges").alias("part"), big("shard"), "column_id", "src", "dst", total("attr"))
    return n.unionByName(e)


@query("g3_graph_batch", f"""WITH {FAM}, {_TEMPLATE}
  SELECT 'node' AS part, column_id // 24 AS batch_id, column_id, l + column_id % 24 * 16 AS src, l + column_id % 24 * 16 AS dst
    FROM ids, range(16) r(l)
  UNION ALL SELECT 'edge', column_id // 24, column_id, src + column_id % 24 * 16, dst + column_id % 24 * 16 FROM ids, tpl""")
def _(spark, sf):
    nodes, edges = pathgraph.graph_batch(*pathgraph.build_graphs(_features(spark, sf)), 24, LEVELS)
    n = nodes.select(F.lit("node").alias("part"), "batch_id", "column_id", F.col("node").alias("src"), F.col("node").alias("dst"))
    return n.unionByName(edges.select(F.lit("edge").alias("part"), "batch_id", "column_id", "src", "dst"))


@query("g5_graph_get", f"""WITH {FAM}, {_TEMPLATE}
  SELECT 'node' AS part, column_id, level AS src, level AS dst FROM lvl WHERE column_id = 137 AND variable = 0
  UNION ALL SELECT 'edge', column_id, src, dst FROM ids, tpl WHERE column_id = 137""")
def _(spark, sf):
    path = scratch_path(spark, "graphs")
    feats = _features(spark, sf)
    n = feats.count()
    shards.write_graphs(feats, path, 10, n, uneven=True)
    nodes, edges = pathgraph.graph_get(spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges"), 137, n // 10)
    one = nodes.select(F.lit("node").alias("part"), "column_id", F.col("node").alias("src"), F.col("node").alias("dst"))
    return one.unionByName(edges.select(F.lit("edge").alias("part"), "column_id", "src", "dst"))


# One head of two outputs over the four variables of a level, and two heads for the averaged form.
_W = [[0.5, -0.25, 1.0, 0.75], [-0.6, 0.3, 0.2, 0.9]]
_W2 = [[0.1, 0.2, -0.3, 0.4], [0.7, -0.8, 0.6, -0.5]]
ONE_HEAD = attention.AttentionWeights(w=[_W], src=[[1.5, -0.5]], dst=[[0.25, 0.75]], bias=[0.1, -0.2])
TWO_HEADS = attention.AttentionWeights(w=[_W, _W2], src=[[1.5, -0.5], [0.4, 0.3]], dst=[[0.25, 0.75], [-0.9, 1.1]])


def _head_sql(prefix: str, w, src, dst, along: str = "0") -> str:
    """CTEs ending in {prefix}o(column_id, node, o0, o1)."""
    def double(value):
        return f"CAST({value} AS DOUBLE)"

    h = [" + ".join(f"{double(c)} * {v}" for c, v in zip(row, "abcd")) for row in w]
    leaky = "CASE WHEN s > 0 THEN s ELSE s * CAST(0.2 AS DOUBLE) END"
    return f"""{prefix}h AS (SELECT column_id, node, {h[0]} AS h0, {h[1]} AS h1 FROM nodes),
  {prefix}e AS (SELECT m.column_id, m.dst, s.h0, s.h1,
      s.h0 * {double(src[0])} + s.h1 * {double(src[1])} + d.h0 * {double(dst[0])} + d.h1 * {double(dst[1])} + {along} AS s
    FROM links m JOIN {prefix}h s ON s.column_id = m.column_id AND s.node = m.src
                 JOIN {prefix}h d ON d.column_id = m.column_id AND d.node = m.dst),
  {prefix}w AS (SELECT column_id, dst, h0, h1, exp({leaky} - max({leaky}) OVER (PARTITION BY column_id, dst)) AS a FROM {prefix}e),
  {prefix}o AS (SELECT column_id, dst AS node, sum(a * h0) / sum(a) AS o0, sum(a * h1) / sum(a) AS o1 FROM {prefix}w GROUP BY ALL)"""


_GRAPH = LVL + f""", {_TEMPLATE}, ids AS (SELECT vec_id AS column_id FROM embeddings),
  links AS (SELECT column_id, src, dst, layer FROM ids, tpl UNION ALL SELECT column_id, l, l, NULL FROM ids, range(16) r(l)),
  nodes AS (SELECT column_id, level AS node, max(v) FILTER (variable = 0) AS a, max(v) FILTER (variable = 1) AS b,
    max(v) FILTER (variable = 2) AS c, max(v) FILTER (variable = 3) AS d FROM lvl GROUP BY ALL)"""


def _graph(spark, sf):
    records = profiles(spark, sf).withColumn("t", node_targets("a", "b", "c", "d"))
    nodes = records.select("column_id", F.posexplode("t").alias("node", "x"))
    return nodes.withColumn("node", big("node")), pathgraph.path_edges(records, ID, LEVELS)


def _two(out):
    return out.select("column_id", "node", rnd(F.col("out")[0]).alias("o0"), rnd(F.col("out")[1]).alias("o1"))


@query("g4_attention_layer", f"""WITH {_GRAPH}, {_head_sql('p', _W, [1.5, -0.5], [0.25, 0.75])}
  SELECT column_id, node, {sql_rnd('o0 + CAST(0.1 AS DOUBLE)')} AS o0, {sql_rnd('o1 - CAST(0.2 AS DOUBLE)')} AS o1 FROM po""")
def _(spark, sf):
    return _two(attention.attention_layer(*_graph(spark, sf), ONE_HEAD))


_ALONG = "coalesce(CAST(0.3 AS DOUBLE) * m.layer / 10 - CAST(0.1 AS DOUBLE), 0)"


@query("g4_attention_edge_term", f"""WITH {_GRAPH}, {_head_sql('p', _W, [1.5, -0.5], [0.25, 0.75], _ALONG)}
  SELECT column_id, node, {sql_rnd('o0 + CAST(0.1 AS DOUBLE)')} AS o0, {sql_rnd('o1 - CAST(0.2 AS DOUBLE)')} AS o1 FROM po""")
def _(spark, sf):
    """Edges with two attributes: a tenth of their layer, and one half."""
    nodes, _ = _graph(spark, sf)
    edges = pathgraph.attach_edges(profiles(spark, sf), ID, LEVELS)
    edges = edges.select("column_id", "src", "dst", F.array(F.col("layer") / 10.0, F.lit(0.5)).alias("attr"))
    return _two(attention.attention_layer(nodes, edges, replace(ONE_HEAD, edge=[[0.3, -0.2]])))


@query("g4_attention_heads_averaged", f"""WITH {_GRAPH}, {_head_sql('p', _W, [1.5, -0.5], [0.25, 0.75])},
  {_head_sql('q', _W2, [0.4, 0.3], [-0.9, 1.1])}
  SELECT column_id, node, {sql_rnd('(p.o0 + q.o0) / 2')} AS o0, {sql_rnd('(p.o1 + q.o1) / 2')} AS o1
  FROM po p JOIN qo q USING (column_id, node)""")
def _(spark, sf):
    return _two(attention.attention_layer(*_graph(spark, sf), TWO_HEADS, concat=False))


@query("g4_path_attention", SQL["g4_attention_layer"])
def _(spark, sf):
    records = profiles(spark, sf).select("column_id", "m")
    out = attention.path_attention(records, [ONE_HEAD], "m", concat_last=True)
    levels = out.select("column_id", F.posexplode("out").alias("node", "out"))
    return _two(levels.withColumn("node", big("node")))


@query("g4_path_attention_heads_averaged", SQL["g4_attention_heads_averaged"])
def _(spark, sf):
    out = attention.path_attention(profiles(spark, sf).select("column_id", "m"), [TWO_HEADS], "m")
    levels = out.select("column_id", F.posexplode("out").alias("node", "out"))
    return _two(levels.withColumn("node", big("node")))


def _record_graphs(spark, sf):
    """Records with their nodes and the two-attribute edges of the edge term's query."""
    records = profiles(spark, sf).select("column_id", node_targets("a", "b", "c", "d").alias("x"))
    edges = pathgraph.attach_edges(profiles(spark, sf), ID, LEVELS)
    edges = edges.select("column_id", "src", "dst", F.array(F.col("layer") / 10.0, F.lit(0.5)).alias("attr"))
    return attention.with_edges(records, edges, attr="attr")


@query("g4_record_attention", SQL["g4_attention_edge_term"])
def _(spark, sf):
    """The edge term inside the record: nothing but the edges' first grouping moves."""
    out = attention.record_attention(_record_graphs(spark, sf), [replace(ONE_HEAD, edge=[[0.3, -0.2]])], attrs="attrs", concat_last=True)
    nodes = out.select("column_id", F.posexplode("out").alias("node", "out"))
    return _two(nodes.withColumn("node", big("node")))
