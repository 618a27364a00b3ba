"""Small hand-written inputs with known results."""

import math

import pytest
from pyspark.sql import functions as F

from gridframe.functions import arrays, draws, physics
from gridframe.operators import batches, index, moments, normalize, pathgraph, split, trials
from gridframe.schema import FAMILIES, family_of, variable_index
from gridframe.sources import catalog, shards
from gridframe.sources.columns import reject_nulls


def one(spark, row, schema, expression):
    return spark.createDataFrame([row], schema).select(expression.alias("r")).first()["r"]


def test_families():
    assert [len(FAMILIES[f]) for f in ("sca_inputs", "col_inputs", "hl_inputs", "inter_inputs")] == [17, 27, 2, 1]
    assert family_of("q_ice") == "col_inputs" and variable_index("col_inputs", "q_ice") == 24


def test_pad(spark):
    assert one(spark, ([[1.0], [2.0]],), "m array<array<float>>", arrays.pad_levels("m")) == [[0], [1], [2], [0]]


def test_pad_without_rows(spark):
    assert one(spark, ([],), "m array<array<float>>", arrays.pad_levels("m", width=1)) == [[0], [0]]


def test_node_features(spark):
    row = ([[1.0, 2.0], [3.0, 4.0], [5.0, 6.0]], [[9.0]], [7.0, 8.0])
    found = one(spark, row, "hl array<array<float>>, i array<array<float>>, s array<float>", arrays.node_features("hl", "i", "s"))
    assert found == [[1, 2, 0, 7, 8], [3, 4, 9, 7, 8], [5, 6, 0, 7, 8]]


def test_node_targets_of_unequal_length_fail(spark):
    with pytest.raises(Exception, match="differ in length"):
        one(spark, ([1.0, 2.0], [1.0]), "a array<float>, b array<float>", arrays.node_targets("a", "b"))


def test_flatten_and_back(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0]],)], "m array<array<float>>")
    df = df.withColumn("v", arrays.flatten_row("m")).withColumn("b", arrays.reshape_row("v", 2, 2))
    row = df.first()
    assert row["v"] == [1, 2, 3, 4] and row["b"] == row["m"]


def test_moments(spark):
    df = spark.createDataFrame([([1.0],), ([3.0],)], "x array<float>")
    row = moments.position_moments(df, ["x"]).first()
    assert (row["array"], row["pos"], row["n"], row["mean"], row["std"]) == ("x", 0, 2, 2.0, 1.0)


def test_normalize_without_spread(spark):
    df = spark.createDataFrame([([5.0],), ([5.0],)], "x array<double>")
    scaled = normalize.normalize(df, "x", moments.position_moments(df, ["x"]))
    assert [r["x"] for r in scaled.collect()] == [[0.0], [0.0]]


def test_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in range(5)], "v double")
    rows = moments.histogram(df, "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [1, 1, 1, 2]
    assert [r["density"] for r in rows] == pytest.approx([0.2, 0.2, 0.2, 0.4])


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,)] * 3, "v double")
    rows = moments.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [0, 0, 3, 0, 0]
    assert (rows[0]["low"], rows[-1]["high"]) == (1.5, 2.5)


def test_heating_rate(spark):
    c = -9.80665 / 1004 * 86400
    schema = "d array<double>, u array<double>, p array<double>"
    rate = physics.heating_rate("d", "u", "p")
    assert one(spark, ([3.0, 2.0, 0.0], [0.0] * 3, [0.0, 10.0, 30.0]), schema, rate) == pytest.approx([-0.1 * c, -0.1 * c])
    assert one(spark, ([3.0, 2.0], [0.0] * 2, [5.0, 5.0]), schema, rate) == [None]


def test_path_edges(spark):
    rows = pathgraph.path_edges(spark.range(1), ["id"], 3).collect()
    assert [(r["src"], r["dst"]) for r in rows] == [(1, 0), (2, 1), (0, 1), (1, 2)]


def test_edge_attributes(spark):
    df = spark.createDataFrame([(0, [[1.0], [2.0]])], "column_id bigint, edge array<array<float>>")
    found = {(r["src"], r["dst"]): r["attr"] for r in pathgraph.graph_edges(df).collect()}
    assert found == {(1, 0): [1.0], (0, 1): [1.0], (2, 1): [2.0], (1, 2): [2.0]}


def test_full_size_path(spark):
    assert pathgraph.path_edges(spark.range(1), ["id"], 138).count() == 274


def test_shard_plan(spark):
    sizes = spark.createDataFrame([("columns", 1_085_440), ("odd", 7), ("none", 0)], "name string, n_rows bigint")
    found = {r["name"]: (r["num_shards"], r["shard_size"]) for r in index.plan_shards(sizes, 3392).collect()}
    assert found == {"columns": (3392, 320), "odd": (7, 1)}


def test_locate(spark):
    shard, row = index.locate(F.lit(641), 320)
    found = spark.range(1).select(shard.alias("s"), row.alias("r")).first()
    assert (found["s"], found["r"]) == (2, 1)


def test_reshard_is_disjoint_and_complete(spark, tmp_path):
    df = spark.range(24).withColumnRenamed("id", "column_id")
    shards.reshard(df, str(tmp_path / "out"), ranks=2, files_per_rank=3, rows_per_file=4)
    stored = spark.read.parquet(str(tmp_path / "out"))
    pieces = stored.groupBy("rank", "shard").count().collect()
    assert sorted((p["rank"], p["shard"], p["count"]) for p in pieces) == [(r, r * 3 + s, 4) for r in (0, 1) for s in range(3)]
    assert sorted(r["column_id"] for r in stored.collect()) == list(range(24))
    with pytest.raises(ValueError):
        shards.reshard(df, str(tmp_path / "out"), ranks=1, files_per_rank=5, rows_per_file=4)


@pytest.mark.parametrize("how", [split.random_split, split.shuffled_slices])
@pytest.mark.parametrize("n, sizes", [(25, (20, 2, 3)), (1, (0, 0, 1)), (10, (8, 1, 1))])
def test_split_sizes(spark, how, n, sizes):
    rows = how(spark.range(n), "id", 3).groupBy("split").count().collect()
    found = {r["split"]: r["count"] for r in rows}
    assert tuple(found.get(k, 0) for k in ("train", "val", "test")) == sizes


def test_split_without_rest(spark):
    rows = split.shuffled_slices(spark.range(10), "id", 3, 0.5, 1.0).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in rows} == {"train": 5, "val": 5}


def test_head_holdout(spark):
    val, train = batches.head_tail_batches(spark.range(10), "id", 4, 3)
    assert sorted(r["id"] for r in val.collect()) == [0, 1, 2]
    assert sorted({r["batch_id"] for r in train.collect()}) == [1, 2, 3]


def test_rank_batches_need_a_row_each(spark):
    with pytest.raises(ValueError):
        batches.rank_batches(spark.range(4), "id", 2, 3)


def test_running_score(spark):
    df = spark.createDataFrame([(0, 2, True), (1, 2, False)], "trial_id bigint, p int, c boolean")
    rows = trials.toy_objective(df, 3, cumulate="c").orderBy("trial_id", "iteration").collect()
    assert [round(r["score"], 4) for r in rows] == [0.5, 0.8333, 1.0833, 0.5, 0.3333, 0.25]


def test_halving(spark):
    rows = [(t, i, float(t)) for t in range(9) for i in range(1, 10)]
    history = spark.createDataFrame(rows, "trial_id bigint, iteration int, score double")
    assert trials.milestones(9, 1, 3) == [1, 3] and trials.milestones(100, 3, 3) == [3, 9, 27, 81]
    stops = {r["trial_id"]: r["stopped_at"] for r in trials.early_stop(history, 9, 1, 3).collect()}
    assert stops == {0: 9, 1: 3, 2: 3, **{t: 1 for t in range(3, 9)}}
    best = {r["trial_id"]: r["stopped_at"] for r in trials.early_stop(history, 9, 1, 3, mode="max").collect()}
    assert best[8] == 9 and best[0] == 1


def test_halving_keeps_trials_that_end_early(spark):
    rows = [(0, 1, 5.0), (1, 1, 1.0), (1, 2, 1.0), (2, 1, 2.0), (2, 2, 2.0)]
    history = spark.createDataFrame(rows, "trial_id bigint, iteration int, score double")
    stops = {r["trial_id"]: r["stopped_at"] for r in trials.early_stop(history, 4, 2, 2).collect()}
    assert stops == {0: 1, 1: 2, 2: 2}


def test_catalog(spark, tmp_path):
    path = str(tmp_path / "catalog")

    def entry(kind, length):
        df = spark.range(length).select(F.lit(0).alias("shard"), F.array(F.lit(1.0).cast("float")).alias("x"))
        return catalog.describe_table(df, 250, kind)

    catalog.catalog_upsert(spark, path, entry("flattened", 3))
    catalog.catalog_upsert(spark, path, entry("features", 4))
    catalog.catalog_upsert(spark, path, entry("features", 5))
    found = {r["kind"]: r["dataset_len"] for r in catalog.read_catalog(spark, path).collect()}
    assert found == {"flattened": 3, "features": 5}
    row = catalog.entry_of(spark, path, 250, "features")
    assert (row["dtype"], row["num_shards"], row["x_shape"], row["y_shape"]) == ("float32", 1, [1], None)
    with pytest.raises(KeyError):
        catalog.entry_of(spark, path, 500, "features")


def test_shape_check_fails_the_job(spark):
    from pyspark.sql import Row

    df = spark.createDataFrame([([1.0, 2.0],)], "x array<float>")
    shape = {"x_shape": [2], "y_shape": None, "edge_shape": None}
    assert shards.check_shapes(df, Row(**shape)).first()["x"] == [1.0, 2.0]
    with pytest.raises(Exception, match="not of shape"):
        shards.check_shapes(df, Row(**{**shape, "x_shape": [3]})).collect()


def test_nulls_are_rejected(spark):
    df = spark.createDataFrame([([[1.0], [2.0]],)], "m array<array<float>>")
    assert reject_nulls(df, ["m"]).count() == 1
    for bad in ([[1.0], [None]], [[1.0], None], None):
        with pytest.raises(Exception, match="missing value"):
            reject_nulls(spark.createDataFrame([(bad,)], "m array<array<float>>"), ["m"]).collect()


def test_draws(spark):
    df = spark.range(2000).select(draws.uniform_draw("id", 1, "a").alias("u"), draws.normal_draw("id", 1, "a").alias("g"))
    row = df.agg(F.min("u"), F.max("u"), F.avg("u"), F.avg("g"), F.stddev_pop("g")).first()
    assert 0 <= row[0] and row[1] < 1 and math.isclose(row[2], 0.5, abs_tol=0.03)
    assert abs(row[3]) < 0.1 and abs(row[4] - 1) < 0.1


def test_grid_lists_every_combination_once(spark):
    space = {"a": trials.grid_search([1, 2, 3]), "b": trials.grid_search(["x", "y"])}
    rows = trials.sample_space(spark.range(2).withColumnRenamed("id", "trial_id"), space).collect()
    assert len({(r["trial_id"], r["a"], r["b"]) for r in rows}) == len(rows) == 12
    assert {r["grid_id"] for r in rows} == set(range(6))
