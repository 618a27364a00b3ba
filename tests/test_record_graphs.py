"""Attention over any graph inside a record, against the form over node and edge tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridframe.operators import attention

EDGES = "column_id long, src long, dst long, attr array<double>"


def weights(rng, heads, width, inputs, attrs):
    draw = lambda *shape: rng.normal(size=shape).tolist()
    return attention.AttentionWeights(draw(heads, width, inputs), draw(heads, width), draw(heads, width), None, draw(heads, attrs) if attrs else None)


@pytest.fixture(scope="module")
def graphs(spark):
    """Graphs of unlike size: one without edges, one of a single node, double edges and edges to oneself."""
    rng = np.random.default_rng(1)
    sizes = [5, 1, 7, 3, 4]
    records = [(g, rng.normal(size=(n, 3)).tolist()) for g, n in enumerate(sizes)]
    edges = []
    for g, n in enumerate(sizes):
        for _ in range(0 if g in (1, 3) else 4 * n):
            edges.append((g, int(rng.integers(n)), int(rng.integers(max(n - 2, 1))), rng.normal(size=2).tolist()))
    edges += edges[:2]
    rows = spark.createDataFrame(records, "column_id long, x array<array<double>>").repartition(2)
    return rows, spark.createDataFrame(edges, EDGES).repartition(3)


def by_node(df, name):
    return {(r["column_id"], r["node"]): r[name] for r in df.collect()}


def test_lists_hold_every_edge(graphs):
    rows, edges = graphs
    expected = {}
    for e in edges.collect():
        expected.setdefault(e["column_id"], []).append((e["dst"], e["src"], e["attr"]))
    for r in attention.with_edges(rows, edges, attr="attr").collect():
        assert len(r["starts"]) == len(r["x"]) + 1 and r["starts"][0] == 0 and r["starts"][-1] == len(r["sources"])
        into = np.repeat(np.arange(len(r["x"])), np.diff(r["starts"])).tolist()
        assert sorted(zip(into, r["sources"], r["attrs"])) == sorted(expected.get(r["column_id"], []))


@pytest.mark.parametrize("attrs", [0, 2])
def test_record_form_equals_table_form(graphs, attrs):
    rows, edges = graphs
    rng = np.random.default_rng(attrs)
    layer = weights(rng, 2, 3, 3, attrs)
    nodes = rows.select("column_id", F.posexplode("x").alias("node", "x")).withColumn("node", F.col("node").cast("long"))
    table = by_node(attention.attention_layer(nodes, edges, layer), "out")
    lists = attention.with_edges(rows, edges, attr="attr")
    out = attention.record_attention(lists, [layer], attrs="attrs", concat_last=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    record = by_node(out.select("column_id", F.posexplode("out").alias("node", "out")), "out")
    assert record.keys() == table.keys()
    for key, value in record.items():
        assert value == pytest.approx(table[key])


def test_layers_shuffle_nothing(spark, graphs, tmp_path):
    rows, edges = graphs
    attention.with_edges(rows, edges, attr="attr").write.parquet(str(tmp_path / "graphs"))
    rng = np.random.default_rng(4)
    stack = [weights(rng, 2, 3, 3, 2), weights(rng, 1, 2, 6, 2)]
    stored = spark.read.parquet(str(tmp_path / "graphs"))
    out = attention.record_attention(stored, stack, attrs="attrs")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    nodes = rows.select("column_id", F.posexplode("x").alias("node", "x")).withColumn("node", F.col("node").cast("long"))
    table = by_node(attention.attention_network(nodes, edges, stack), "x")
    for key, value in by_node(out.select("column_id", F.posexplode("out").alias("node", "out")), "out").items():
        assert value == pytest.approx(table[key])


def test_edges_out_of_the_graph_fail(spark, graphs):
    rows, _ = graphs
    for src, dst in ((0, 9), (-1, 0)):
        bad = spark.createDataFrame([(0, src, dst, [1.0, 2.0])], EDGES)
        with pytest.raises(Exception, match="an edge leaves graph 0"):
            attention.with_edges(rows, bad).collect()
    with pytest.raises(ValueError):
        attention.record_attention(rows, [weights(np.random.default_rng(0), 1, 1, 3, 2)])
