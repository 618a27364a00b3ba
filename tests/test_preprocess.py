"""The whole way from records to shards, catalogue, statistics and graphs."""

import pytest
from pyspark.sql import functions as F

from checks.tables import columns
from gridframe.operators.moments import position_moments
from gridframe.operators.pathgraph import graph_get
from gridframe.plans import preprocess


def test_tables_statistics_and_graphs(spark, sf, tmp_path):
    root, records = str(tmp_path), columns(spark, sf)
    flat = preprocess.build_table(records, root, 250, "flattened", 24)
    feats = preprocess.build_table(records, root, 250, "features", 24, n_rows=500, files_per_shard=2)
    assert (flat["dataset_len"], flat["num_shards"], flat["x_shape"], flat["y_shape"]) == (500, 25, [468], [64])
    assert (feats["x_shape"], feats["y_shape"], feats["edge_shape"]) == ([16, 20], [16, 4], [15, 27])

    stats = preprocess.build_stats(spark, root, 250, "flattened")
    assert {r["array"]: r["n"] for r in stats.groupBy("array").agg(F.count("*").alias("n")).collect()} == {"x": 468, "y": 64}
    scaled = position_moments(preprocess.normalized_table(spark, root, 250, "flattened"), ["x"])
    worst = scaled.agg(F.max(F.abs("mean")).alias("m"), F.max(F.abs(F.col("std") - 1)).alias("s")).first()
    assert worst["m"] < 1e-6 and worst["s"] < 1e-4

    preprocess.build_graph_tables(spark, root, 250)
    nodes, edges = (spark.read.parquet(f"{root}/graphs-250/{t}") for t in ("nodes", "edges"))
    one_nodes, one_edges = graph_get(nodes, edges, 321, 20)
    assert one_nodes.count() == 16 and one_edges.count() == 30
    assert nodes.count() == 500 * 16 and edges.count() == 500 * 30
    by_file = preprocess.read_table(spark, root, 250, "features").withColumn("file", F.input_file_name())
    assert by_file.select("file").distinct().count() == 50


def test_ragged_records_are_refused(spark, sf, tmp_path):
    records = columns(spark, sf)
    longer = F.when(F.col("column_id") == 7, F.concat("flux_up_lw", F.array(F.lit(0).cast("float")))).otherwise(F.col("flux_up_lw"))
    with pytest.raises(ValueError, match="length of y"):
        preprocess.build_table(records.withColumn("flux_up_lw", longer), str(tmp_path), 250, "flattened", 24)
