"""Joins of bucketed tables, zone maps, and statistics that are merged instead of computed again."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from checks import layout
from checks.tables import columns
from gridframe.operators import align, moments
from gridframe.operators.index import with_row_id
from gridframe.plans import preprocess
from gridframe.sources import buckets, catalog, zones


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    rows = spark.range(500).select(F.col("id").alias("column_id"), F.array(F.col("id") * 2.0).alias("x"))
    names = [f"zip_{i}_{os.getpid()}" for i in range(3)]
    for name, array in zip(names, "xye"):
        buckets.write_buckets(rows.where(f"column_id % 7 <> {len(array)}").withColumnRenamed("x", array), name, str(tmp_path / name), 6)
    zipped = align.zip_buckets(spark, names)
    plan = plan_of(zipped)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") >= 2
    got = sorted((r["column_id"], r["x"][0], r["e"][0]) for r in zipped.collect())
    assert got == [(i, i * 2.0, i * 2.0) for i in range(500) if i % 7 != 1]
    assert len([f for f in os.listdir(tmp_path / names[0]) if f.endswith(".parquet")]) == 6
    for name in names:
        buckets.drop_buckets(spark, name)


def test_bucket_query_moves_no_row(spark, sf):
    assert "Exchange" not in plan_of(layout.QUERIES["j1_zip_buckets"](spark, sf))


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("zones of")  # a blank in the path
    rows = spark.range(8000).select((F.col("id") * 3).alias("id"), (F.col("id") % 11).alias("v"))
    stored, zoned = str(path / "rows"), str(path / "zones")
    zones.write_indexed(rows.repartitionByRange(40, "id").sortWithinPartitions("id"), stored, zoned, "id")
    return stored, zoned, rows.schema


def test_ten_scattered_ids_open_ten_files_at_most(spark, indexed):
    stored, zoned, schema = indexed
    ids = random.Random(1).sample(range(8000), 10)
    wanted = spark.createDataFrame([(i * 3,) for i in ids], "id long")
    found = zones.fetch_indexed(spark, stored, zoned, wanted, "id", schema)
    assert len(spark.read.parquet(stored).inputFiles()) == 40
    assert len(found.inputFiles()) <= 10
    assert "PushedFilters: [In(id" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["id"], r["v"]) for r in found.collect()) == sorted((i * 3, i % 11) for i in ids)


def test_other_ids(spark, indexed):
    stored, zoned, schema = indexed
    fetch = lambda rows: zones.fetch_indexed(spark, stored, zoned, spark.createDataFrame(rows, "id long"), "id", schema)
    assert fetch([]).count() == 0 and fetch([(None,)]).count() == 0
    assert fetch([(-5,), (10**9,)]).count() == 0
    assert sorted(r["id"] for r in fetch([(0,), (0,), (None,), (1,), (23997,)]).collect()) == [0, 23997]
    many = [(i,) for i in range(0, 900)]
    found = fetch(many + many)
    assert len(found.inputFiles()) <= 3
    assert sorted(r["id"] for r in found.collect()) == list(range(0, 900, 3))


def test_zones_of_unsorted_files_and_null_ids(spark, tmp_path):
    rows = spark.createDataFrame([(i if i % 5 else None, i) for i in range(100)], "id long, v long").repartition(4)
    zones.write_indexed(rows, str(tmp_path / "rows"), str(tmp_path / "zones"), "id")
    wanted = spark.createDataFrame([(i,) for i in range(0, 100, 3)], "id long")
    found = zones.fetch_indexed(spark, str(tmp_path / "rows"), str(tmp_path / "zones"), wanted, "id", rows.schema)
    assert sorted(r["id"] for r in found.collect()) == [i for i in range(0, 100, 3) if i % 5]


def test_merged_states_equal_a_full_pass(spark):
    """Also where the means are large against the deviations."""
    rng = random.Random(2)
    rows = [(i, i % 3, [1e8 + rng.random(), None if i % 9 == 0 else rng.random() * i, 4.0]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, part int, x array<double>").repartition(5)
    merged = {r["pos"]: r for r in moments.merge_states(moments.position_states(df, ["x"], ["part"])).collect()}
    for pos in range(3):
        values = [r[2][pos] for r in rows if r[2][pos] is not None]
        mean = math.fsum(values) / len(values)
        std = math.sqrt(math.fsum((v - mean) ** 2 for v in values) / len(values))
        assert (merged[pos]["n"], merged[pos]["mean"]) == (len(values), pytest.approx(mean, rel=1e-12))
        assert merged[pos]["std"] == pytest.approx(std, rel=1e-7, abs=1e-12)


def test_a_new_timestep_reads_only_itself(spark, sf, tmp_path, monkeypatch):
    records = with_row_id(columns(spark, sf).drop("column_id"), ["patch", "sca_inputs"], "column_id").cache()
    root = str(tmp_path)
    for step in (0, 250):
        part = records.withColumn("sca_inputs", F.transform("sca_inputs", lambda v: v + F.lit(float(step)).cast("float")))
        preprocess.build_table(part, root, step, "flattened", 4)
    first = {r["pos"]: r for r in preprocess.update_stats(spark, root, 0, "flattened").where("array = 'x'").collect()}
    both = preprocess.read_table(spark, root, 0, "flattened").unionByName(preprocess.read_table(spark, root, 250, "flattened"))
    whole = {r["pos"]: r for r in moments.position_moments(both, ["x"]).collect()}
    read, opened = preprocess.read_table, []
    monkeypatch.setattr(preprocess, "read_table", lambda *a: opened.append(read(*a)) or opened[-1])
    rows = {r["pos"]: r for r in preprocess.update_stats(spark, root, 250, "flattened").where("array = 'x'").collect()}
    again = preprocess.update_stats(spark, root, 250, "flattened")
    assert all("flattened-250" in f or "states-flattened" in f for df in [*opened, again] for f in df.inputFiles())
    again = again.where("array = 'x'").collect()
    assert len(rows) == len(whole) == len(again)
    for pos, r in rows.items():
        assert r["n"] == whole[pos]["n"] == 2 * first[pos]["n"]
        assert r["mean"] == pytest.approx(whole[pos]["mean"], rel=1e-9, abs=1e-9)
        assert r["std"] == pytest.approx(whole[pos]["std"], rel=1e-6, abs=1e-6)
    assert sorted(f for f in os.listdir(f"{root}/states-flattened") if "=" in f) == ["timestep=0", "timestep=250"]
    assert catalog.load_states(spark, f"{root}/states-flattened", ["y"]).select("array").distinct().count() == 1
