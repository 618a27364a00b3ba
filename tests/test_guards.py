"""Input that once gave a wrong answer in silence: it must raise, or be handled."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridframe.operators import attention, evaluate, index, normalize, pathgraph, trials
from gridframe.plans import learn
from gridframe.sources import catalog, columns, shards

RAGGED = [[(1, [1.0, 2.0]), (2, [3.0]), (3, [4.0, 5.0, 6.0])], [(1, [1.0]), (2, None)], [(1, [1.0, None]), (2, [1.0, 2.0])]]


@pytest.mark.parametrize("rows", RAGGED)
def test_ragged_records_are_not_scored(spark, rows):
    df = spark.createDataFrame(rows, "column_id long, x array<double>").coalesce(1)
    net = learn.Network([np.ones((2, 1)), np.zeros(1)])
    with pytest.raises(Exception, match="batch"):
        learn.predict(df, net, "x").collect()


def test_ragged_records_are_not_attended(spark):
    df = spark.createDataFrame([(1, [[1.0]]), (2, [[1.0], [2.0], [3.0]])], "column_id long, x array<array<double>>").coalesce(1)
    weights = attention.AttentionWeights([[[1.0]]], [[1.0]], [[1.0]])
    with pytest.raises(Exception, match="batch"):
        attention.path_attention(df, [weights]).collect()


@pytest.mark.parametrize("pair", [([1.0, 2.0], [1.0, 2.0, 9.0]), (None, [1.0]), ([1.0], None)])
def test_unequal_lengths_have_no_error(spark, pair):
    df = spark.createDataFrame([(1, 0, *pair)], "stage int, batch int, p array<double>, t array<double>")
    for call in (
        lambda: evaluate.mse(df, "p", "t"),
        lambda: evaluate.mae(df, {"a": ("p", "t")}),
        lambda: evaluate.weighted_mse(df, {"a": ("p", "t")}),
        lambda: evaluate.stage_metrics(df, "stage", "batch", "p", "t"),
    ):
        with pytest.raises(Exception, match="differ in length"):
            call().collect()


def test_records_longer_than_their_statistics(spark):
    stats = spark.createDataFrame([("x", i, 1, 0.0, 1.0) for i in range(2)], "array string, pos int, n long, mean double, std double")
    for value in ([1.0, 2.0, 3.0], [1.0]):
        with pytest.raises(Exception, match="statistics"):
            normalize.normalize(spark.createDataFrame([(1, value)], "column_id long, x array<double>"), "x", stats).collect()
    for value in ([[1.0, 2.0], [3.0, 4.0]], [[1.0], [2.0, 3.0]]):
        with pytest.raises(Exception, match="statistics"):
            normalize.normalize(spark.createDataFrame([(1, value)], "column_id long, x array<array<double>>"), "x", stats).collect()
    empty = normalize.normalize(spark.createDataFrame([(1, None)], "column_id long, x array<double>"), "x", stats)
    assert empty.first()["x"] is None


def test_graphs_need_equal_and_divisible_records(spark, tmp_path):
    uneven = spark.createDataFrame([(0, [[1.0], [2.0]], [[1.0]], [[0.0]])], "column_id long, x array<array<double>>, y array<array<double>>, edge array<array<double>>")
    with pytest.raises(Exception, match="differ in length"):
        pathgraph.graph_nodes(uneven).collect()
    with pytest.raises(ValueError, match="equal shards"):
        shards.write_graphs(uneven, str(tmp_path), num_shards=2)
    with pytest.raises(Exception, match="no place for row"):
        index.rechunk_rows(spark.range(103).withColumnRenamed("id", "row_id"), "row_id", 10, 10).collect()


def test_one_level_has_no_edges(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 0)], "column_id long, n int")
    got = sorted(tuple(r) for r in pathgraph.path_edges(df, ["column_id"], F.col("n")).collect())
    assert got == [(2, 0, 1), (2, 1, 0), (2, 1, 2), (2, 2, 1)]
    assert {r.column_id for r in pathgraph.attach_edges(df, ["column_id"], F.col("n")).collect()} == {2}


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(None, 3), (1, 1), (None, 2), (1, 5)], "g int, v int")
    assert sorted((r.g or 0, r.v, r.position) for r in index.with_group_position(df, ["g"], ["v"]).collect()) == [
        (0, 2, 0), (0, 3, 1), (1, 1, 0), (1, 5, 1),
    ]
    history = spark.createDataFrame([(None, 1, 2.0), (None, 2, 3.0), (7, 1, 1.0)], "trial int, i int, s double")
    got = trials.running_score(history, "trial", "i", "s", block=1).collect()
    assert sorted((r.trial or 0, r.running) for r in got) == [(0, 2.0), (0, 5.0), (7, 1.0)]


def test_positions_of_a_group_over_many_partitions(spark):
    df = spark.range(20_000, numPartitions=5).selectExpr("if(id % 2 = 0, 0, if(id % 3 = 0, null, id % 50)) AS g", "id")
    got = index.with_group_position(df, ["g"], ["id"]).toPandas().sort_values("id")
    want = got.groupby("g", dropna=False).cumcount()
    assert (got["position"] == want).all() and len(got) == 20_000


def test_missing_metrics_lose(spark):
    rows = [(0, 1, None), (1, 1, float("nan")), (2, 1, 0.2), (3, 1, 0.4)]
    df = spark.createDataFrame(rows, "trial_id long, iteration long, score double")
    assert trials.best_trial(df, "score", []).first()["trial_id"] == 2
    assert trials.best_trial(df, "score", [], mode="max").first()["trial_id"] == 3
    for mode, order in (("min", [2, 3]), ("max", [3, 2])):
        ranks = {r.trial_id: r["rank"] for r in trials.rung_rank(df, "iteration", "score", mode=mode).collect()}
        assert [ranks[t] for t in order] == [1, 2]


def test_trial_between_milestones_is_judged_by_its_next_report(spark):
    rows = [(0, i, 1.0) for i in range(1, 10)] + [(1, 1, 9.0), (1, 4, 9.0), (1, 8, 9.0)] + [(2, 1, 0.5), (2, 2, 0.5)]
    df = spark.createDataFrame(rows, "trial_id long, iteration long, score double")
    assert sorted(tuple(r) for r in trials.early_stop(df, 9, 3, 3).collect()) == [(0, 9), (1, 4), (2, 2)]


def test_unknown_units_and_missing_pieces(spark, tmp_path):
    with pytest.raises(ValueError, match="unit"):
        columns.load_columns(spark, str(tmp_path), hr_units="K h-1")
    path = f"{tmp_path}/c"
    spark.range(4).selectExpr("id AS column_id", "int(id) * 250 AS timestep", "0 AS patch").write.partitionBy("timestep", "patch").parquet(path)
    with pytest.raises(ValueError, match="1000"):
        columns.load_columns(spark, path, timesteps=[250, 1000], all_present=True)


def test_files_by_number_not_by_text(spark, tmp_path):
    df = spark.createDataFrame([(1000, 1), (250, 2), (10, 3), (2, 4)], "timestep int, v int")
    df.write.partitionBy("timestep").parquet(str(tmp_path / "t"))
    got = index.with_file_position(spark.read.parquet(str(tmp_path / "t")), order_by=["timestep"]).collect()
    assert sorted((r.row_id, r.timestep) for r in got) == [(0, 2), (1, 10), (2, 250), (3, 1000)]


def test_catalogue_passes_over_half_written_versions(spark, tmp_path):
    path, df = f"{tmp_path}/cat", spark.createDataFrame([(0, [1.0, 2.0])], "column_id long, x array<double>")
    entry = catalog.describe_table(df, 250, "flattened", shard=None)
    catalog.catalog_upsert(spark, path, entry)
    (tmp_path / "cat" / "version=1").mkdir()
    catalog.catalog_upsert(spark, path, catalog.describe_table(df, 500, "flattened", shard=None))
    assert sorted(r.step for r in catalog.read_catalog(spark, path).collect()) == [250, 500]
    ragged = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], df.schema)
    with pytest.raises(Exception, match="differ in length"):
        catalog.describe_table(ragged, 1, "flattened", shard=None).collect()


def test_dropout_does_not_depend_on_partitions(spark):
    rows = spark.range(64).selectExpr("id AS column_id", "array(double(id) / 64, 1d) AS x", "array(double(id)) AS y")
    net = learn.Network(learn.initial_weights([2, 8, 1], 1), dropout=0.5)
    got = [learn.step_gradient(rows.repartition(n), net, {"x": "x", "y": "y"}, 3, 1, "column_id")[0] for n in (1, 4)]
    assert got[0] == pytest.approx(got[1], rel=1e-12)
    with pytest.raises(ValueError, match="row id"):
        learn.step_gradient(rows, net, {"x": "x", "y": "y"})
