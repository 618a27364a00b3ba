"""Distributed training against the same steps taken in one process."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridframe.operators import attention, batches, index, moments, pathgraph
from gridframe.plans import learn, search


@pytest.fixture(scope="module")
def records(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(3.0, 2.0, (240, 3))
    y = np.stack([x[:, 0] * x[:, 1], np.sin(x[:, 2])], axis=1)
    rows = [(i, x[i].tolist(), y[i].tolist()) for i in range(240)]
    return spark.createDataFrame(rows, "column_id bigint, x array<double>, y array<double>").repartition(6).persist()


def test_training_follows_the_single_process_steps(records):
    stats = moments.position_moments(records, ["x"])
    net = learn.fit_mlp(records, "x", "y", "column_id", stats, hidden=(5, 4), epochs=2, batch=80, lr=0.01, seed=3, world=2)

    placed = batches.rank_batches(index.shuffle_rows(records, "column_id", 3), "position", 80, 2).toPandas()
    x, y = np.array(placed["x"].tolist()), np.array(placed["y"].tolist())
    single = learn.Network(learn.initial_weights([3, 5, 4, 2], 3), x.mean(0), x.std(0))
    optimiser, rng, losses = learn.Adam(0.01), np.random.default_rng(3), []
    for epoch in range(2):
        for k in range(3) if epoch == 0 else rng.permutation(3):
            mine = (placed["batch_id"] == k).to_numpy()
            loss, slopes = learn.gradient(single, x[mine], {"y": y[mine]})
            losses.append(loss / mine.sum())
            single.weights = optimiser.move(single.weights, [g / mine.sum() for g in slopes])
    assert [h[2] for h in net.history] == pytest.approx(losses)
    assert [h[3] for h in net.history] == [80] * 6
    for ours, theirs in zip(net.weights, single.weights):
        np.testing.assert_allclose(ours, theirs, rtol=1e-7, atol=1e-10)


def test_every_rank_works_in_a_step(spark, records):
    stored = learn.store_batches(records, "column_id", 16, 3, world=4)
    try:
        folders = spark.read.parquet(stored.path).select("rank").distinct().count()
        assert stored.n_batches == 15 and folders == 4
        for k in (0, 14):
            rows = stored.rows(spark, k)
            sizes = rows.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
            assert len(sizes) >= 4 and sum(r["count"] for r in sizes) == 16
    finally:
        stored.remove(spark)
    with pytest.raises(Exception):
        spark.read.parquet(stored.path).count()


def test_dropout_gives_the_same_weights_for_any_partitioning(records):
    targets = {"x": "x", "y": "y"}
    start = learn.Network(learn.initial_weights([3, 8, 2], 1), dropout=0.5)
    nets = [learn._fit(records.repartition(n), start, targets, "column_id", 1, 80, 0.01, 3, 2, f, None, None) for n, f in ((1, 1), (5, 3))]
    for a, b in zip(nets[0].weights, nets[1].weights):
        np.testing.assert_allclose(a, b, rtol=1e-9)


def test_validation_is_reported_per_epoch(records):
    held = records.where("column_id % 5 = 0")
    net = learn.fit_mlp(records, "x", "y", "column_id", hidden=(4,), epochs=2, batch=120, lr=0.01, validation={"val": held})
    assert [(e, n) for e, n, _ in net.reports] == [(0, "train_loss"), (0, "val_loss"), (1, "train_loss"), (1, "val_loss")]
    assert net.reports[-1][2] == pytest.approx(learn.evaluate(held, net, "x", "y", "val").first()["mse"])


def test_loss_falls_and_scoring_agrees(records):
    stats = moments.position_moments(records, ["x"])
    net = learn.fit_mlp(records, "x", "y", "column_id", stats, hidden=(16, 16, 16), epochs=6, batch=120, lr=0.02)
    first = learn.Network(learn.initial_weights([3, 16, 16, 16, 2], 42), net.mean, net.std)
    before = learn.evaluate(records, first, "x", "y", "test").first()["mse"]
    after = learn.evaluate(records, net, "x", "y", "test").first()
    assert after["mse"] < before and after["n"] == 480
    scored = learn.predict(records, net, "x").toPandas()
    expected, _ = learn.forward(net, np.array(scored["x"].tolist()))
    np.testing.assert_allclose(np.array(scored["y_hat"].tolist()), expected)


def test_flux_gradient_against_differences():
    rng = np.random.default_rng(1)
    levels, n = 4, 3
    net = learn.Network(learn.initial_weights([5, 6, 4 * levels], 2, he=True), levels=levels, loss_weights={"hr_sw": 0.5})
    x = rng.normal(size=(n, 5))
    truth = {
        "sw": rng.normal(size=(n, 2 * levels)), "lw": rng.normal(size=(n, 2 * levels)),
        "hr_sw": rng.normal(size=(n, levels - 1)), "hr_lw": rng.normal(size=(n, levels - 1)),
        "pressure": np.cumsum(rng.uniform(500, 900, (n, levels)), axis=1),
    }
    truth["pressure"][0, 2] = truth["pressure"][0, 1]
    _, slopes = learn.gradient(net, x, truth)
    for k, at in ((0, (2, 3)), (1, (1,)), (2, (4, 7)), (3, (5,))):
        step = 1e-6
        net.weights[k][at] += step
        up = learn.gradient(net, x, truth)[0]
        net.weights[k][at] -= 2 * step
        down = learn.gradient(net, x, truth)[0]
        net.weights[k][at] += step
        assert slopes[k][at] == pytest.approx((up - down) / (2 * step), rel=1e-4)


def test_flux_heads_train_and_score(spark):
    rng = np.random.default_rng(4)
    levels = 4
    rows = []
    for i in range(60):
        x = rng.normal(size=3)
        flux = np.outer(np.linspace(1, 2, levels), [x[0], 0.5 * x[1]])
        pressure = np.linspace(100.0, 1000.0, levels)
        rate, _ = learn.heating(flux[None], pressure[None])
        rows.append((i, x.tolist(), flux.ravel().tolist(), flux.ravel().tolist(), rate[0].tolist(), rate[0].tolist(), pressure.tolist()))
    kind = "array<double>"
    schema = f"column_id bigint, x {kind}, sw {kind}, lw {kind}, hr_sw {kind}, hr_lw {kind}, pressure {kind}"
    df = spark.createDataFrame(rows, schema).persist()
    targets = {k: k for k in ("sw", "lw", "hr_sw", "hr_lw", "pressure")}
    net = learn.fit_flux_heads(df, "x", targets, "column_id", levels, width=16, depth=2, dropout=0.0, l1=0, l2=0, lr=0.02, epochs=8, batch=30)
    assert net.history[-1][2] < net.history[0][2]
    losses, absolute = learn.evaluate_flux_heads(df, net, "x", targets)
    row = losses.first()
    assert row["loss"] == pytest.approx(sum(row[f"mse_{k}"] for k in ("sw", "hr_sw", "lw", "hr_lw")))
    assert {r["output"] for r in absolute.collect()} == {"sw", "hr_sw", "lw", "hr_lw"}
    again = learn.fit_flux_heads(df, "x", targets, "column_id", levels, width=8, depth=1, epochs=1, batch=30, seed=5)
    same = learn.fit_flux_heads(df, "x", targets, "column_id", levels, width=8, depth=1, epochs=1, batch=30, seed=5)
    assert [h[2] for h in again.history] == pytest.approx([h[2] for h in same.history])


def test_attention_against_one_process(spark):
    rng = np.random.default_rng(7)
    n, graphs, heads, width = 5, 3, 2, 3
    x = rng.normal(size=(graphs, n, 4))
    w, src, dst = rng.normal(size=(heads, width, 4)), rng.normal(size=(heads, width)), rng.normal(size=(heads, width))
    bias = rng.normal(size=heads * width)
    rows = [(g, i, x[g, i].tolist()) for g in range(graphs) for i in range(n)]
    nodes = spark.createDataFrame(rows, "column_id bigint, node bigint, x array<double>")
    edges = pathgraph.path_edges(spark.range(graphs).withColumnRenamed("id", "column_id"), ["column_id"], n)
    weights = attention.AttentionWeights(w.tolist(), src.tolist(), dst.tolist(), bias.tolist())
    found = {(r["column_id"], r["node"]): r["out"] for r in attention.attention_layer(nodes, edges, weights).collect()}
    assert len(found) == graphs * n
    for g in range(graphs):
        for i in range(n):
            out = []
            near = [j for j in (i - 1, i, i + 1) if 0 <= j < n]
            for k in range(heads):
                h = x[g] @ w[k].T
                s = np.array([h[j] @ src[k] + h[i] @ dst[k] for j in near])
                s = np.where(s > 0, s, 0.2 * s)
                a = np.exp(s - s.max())
                out += list((a / a.sum()) @ h[near])
            assert found[(g, i)] == pytest.approx(list(np.array(out) + bias))


def test_attention_network(spark):
    nodes = spark.range(4).select(F.lit(0).alias("column_id"), F.col("id").alias("node"), F.array(F.lit(1.0), F.lit(-1.0)).alias("x"))
    edges = pathgraph.path_edges(spark.range(1).withColumnRenamed("id", "column_id"), ["column_id"], 4)
    eye = attention.AttentionWeights([[[1.0, 0.0], [0.0, 1.0]]], [[0.0, 0.0]], [[0.0, 0.0]])
    rows = attention.attention_network(nodes, edges, [eye, eye]).collect()
    # Equal neighbours leave values as they are; relu between the layers drops the negative one.
    assert [r["x"] for r in rows] == [[1.0, 0.0]] * 4


def test_trials_report_in_order(spark):
    def objective(p, steps):
        for i in range(steps):
            yield {"score": 1.0 / (p + i), "p": p}

    trials = spark.createDataFrame([(0, 2), (1, 3)], "trial_id bigint, p bigint")
    rows = search.run_trials(trials, objective, ["p"], {"steps": 3}).where("name = 'score'").orderBy("trial_id", "iteration").collect()
    assert [r["value"] for r in rows] == pytest.approx([1 / 2, 1 / 3, 1 / 4, 1 / 3, 1 / 4, 1 / 5])


def test_trials_that_train(spark, records):
    trials = spark.createDataFrame([(0, 0.001), (1, 0.05)], "trial_id bigint, lr double")

    def fit(params):
        net = learn.fit_mlp(records, "x", "y", "column_id", hidden=(4,), batch=240, epochs=2, lr=params["lr"])
        return [(step + 1, "train_loss", loss) for _, step, loss, _ in net.history]

    rows = search.train_trials(trials, fit, at_once=2).collect()
    assert len(rows) == 4 and {r["trial_id"] for r in rows} == {0, 1}
