"""Dense positions under skew, layout of shards, pruning."""

import pytest
from pyspark.sql import functions as F

from gridframe import session
from gridframe.operators import index, moments, normalize, split, trials
from gridframe.sources import shards
from gridframe.sources.columns import load_columns


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in group 0."""
    rows = spark.range(3000).withColumn("g", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    return rows.withColumn("v", F.xxhash64("id") % 100)


def test_row_id_follows_the_order(skewed):
    rows = index.with_row_id(skewed, ["g", "v", "id"]).orderBy("row_id").collect()
    assert [r["row_id"] for r in rows] == list(range(3000))
    keys = [(r["g"], r["v"], r["id"]) for r in rows]
    assert keys == sorted(keys)


def test_group_position_of_a_hot_group(skewed):
    rows = index.with_group_position(skewed, ["g"], ["v", "id"]).where("g = 0").orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(1000))
    assert [(r["v"], r["id"]) for r in rows] == sorted((r["v"], r["id"]) for r in rows)


def test_file_position_over_many_files(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(100, numPartitions=7).write.parquet(path)
    rows = index.with_file_position(spark.read.parquet(path)).orderBy("row_id").collect()
    assert [r["row_id"] for r in rows] == list(range(100)) == [r["id"] for r in rows]


def test_permutation_does_not_depend_on_the_task_count(spark):
    found = [
        {r["id"]: r["position"] for r in index.shuffle_rows(spark.range(500), "id", 9, parts=p).collect()} for p in (1, 5, 32)
    ]
    assert found[0] == found[1] == found[2]
    assert sorted(found[0].values()) == list(range(500))
    other = {r["id"]: r["position"] for r in index.shuffle_rows(spark.range(500), "id", 10).collect()}
    assert other != found[0]


def test_shuffled_rows_lie_in_order(spark):
    rows = index.shuffle_rows(spark.range(500), "id", 9, parts=4).withColumn("task", F.spark_partition_id())
    spans = rows.groupBy("task").agg(F.min("position").alias("a"), F.max("position").alias("b"), F.count("*").alias("n")).collect()
    assert all(s["b"] - s["a"] + 1 == s["n"] for s in spans)


def test_split_matches_the_shuffled_order(spark):
    df = index.shuffle_rows(spark.range(997), "id", 5)
    rows = split.shuffled_slices(df, "id", 5).collect()
    label = {r["position"]: r["split"] for r in rows}
    assert [label[p] for p in range(997)] == ["train"] * 797 + ["val"] * 100 + ["test"] * 100


def test_split_moves_no_rows(spark, sf):
    df = split.random_split(spark.read.parquet(f"{sf}/orders.parquet"), "o_orderkey", 1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Subquery")[0]


def test_shards_are_equal_and_one_file_each(spark, tmp_path):
    path = str(tmp_path / "shards")
    df = spark.range(120).select(F.col("id").alias("column_id"), F.array("id").alias("x"))
    shards.write_shards(df, path, 6)
    stored = spark.read.parquet(path)
    files = stored.withColumn("file", F.input_file_name())
    rows = files.groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("file").alias("f"))
    assert {(r["n"], r["f"]) for r in rows.collect()} == {(20, 1)}
    assert sorted(map(tuple, stored.select("column_id", "x").collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(ValueError):
        shards.write_shards(df, path, 7)


def test_moments_do_not_depend_on_the_shard_count(spark, tmp_path):
    df = spark.range(90).select(F.col("id").alias("column_id"), F.array(F.sqrt("id"), F.sin("id")).alias("x"))
    found = []
    for n in (1, 9):
        path = str(tmp_path / f"s{n}")
        shards.write_shards(df, path, n)
        for route in ("explode", "summarizer"):
            rows = moments.position_moments(spark.read.parquet(path), ["x"], route).orderBy("pos").collect()
            found.append([(r["n"], round(r["mean"], 9), round(r["std"], 9)) for r in rows])
    assert all(f == found[0] for f in found)


def test_moments_of_nearly_constant_values(spark):
    df = spark.range(1000).select(F.array(F.lit(1e8) + F.col("id") % 2).alias("x"))
    for route in ("explode", "summarizer"):
        row = moments.position_moments(df, ["x"], route).first()
        assert row["std"] == pytest.approx(0.5, rel=1e-6)


def test_one_shard_reads_one_directory(spark, tmp_path):
    path = str(tmp_path / "pruned")
    shards.write_shards(spark.range(40).select(F.col("id").alias("column_id"), F.array("id").alias("x")), path, 4)
    schema = spark.read.parquet(path).schema
    plan = shards.read_shard(spark, path, 2, schema).select("x")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan and "ReadSchema: struct<x:array<bigint>>" in plan


def test_row_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "range")
    shards.write_container(spark.range(40).withColumnRenamed("id", "column_id"), path)
    df = shards.read_rows(spark, path, 5, 9, spark.read.parquet(path).schema)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(column_id,5)" in plan and "LessThan(column_id,9)" in plan
    assert sorted(r["column_id"] for r in df.collect()) == [5, 6, 7, 8]


def test_loading_prunes_partitions_and_arrays(spark, sf, tmp_path):
    from checks.tables import columns

    path = str(tmp_path / "columns")
    columns(spark, sf).repartition("timestep").write.partitionBy("timestep", "patch").parquet(path)
    df = load_columns(spark, path, [0, 500], [1, 2], minimal_outputs=True).select("column_id", "sca_inputs")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "timestep" in plan.split("PartitionFilters:")[1].split("]")[0]
    assert "ReadSchema: struct<column_id:bigint,sca_inputs:array<float>>" in plan


def test_normalising_joins_nothing(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    scaled = normalize.normalize(df, "embedding", moments.position_moments(df, ["embedding"]))
    assert "Join" not in scaled._jdf.queryExecution().optimizedPlan().toString().split("Subquery")[0]


def test_running_score_of_one_long_trial(spark):
    df = spark.range(1, 1001).select(F.lit(0).alias("trial_id"), F.col("id").alias("iteration"), F.lit(1.0).alias("score"))
    rows = trials.running_score(df, "trial_id", "iteration", "score", block=64).orderBy("iteration").collect()
    assert [r["running"] for r in rows] == [float(i) for i in range(1, 1001)]


class Named:
    """A session whose settings name a folder, or none, on a cluster."""

    def __init__(self, settings):
        self.conf, self.sparkContext, self.master = settings, self, "spark://host:7077"

    def getConf(self):
        return self.conf


def test_shared_folder_is_the_named_one(spark):
    assert session.shared_folder(Named({"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    assert session.shared_folder(spark)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        session.shared_folder(Named({}))
