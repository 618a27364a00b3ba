"""Keyed permutations, and training that takes one job an epoch."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridframe.functions import permute
from gridframe.operators import batches
from gridframe.plans import learn


def plain_permuted(position, n, *key):
    """One number through the network until it is below n."""
    tall, wide = permute.digits(n)
    mask = (1 << 32) - 1

    def mixed(digit, k):
        h = ((digit + k) & mask) * permute.FACTOR & mask
        h = (h ^ h >> 16) * permute.FACTOR & mask
        return h ^ h >> 16

    while True:
        x, y, a, b = *divmod(position, wide), tall, wide
        for k in permute.round_keys(*key):
            x, y, a, b = y, (x + mixed(y, k)) % a, b, a
        position = x * wide + y
        if position < n:
            return position


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 64, 65, 1000, 9973])
def test_permutation_is_one_to_one_and_has_a_way_back(spark, n):
    df = spark.range(n).select("id", permute.permuted("id", n, 5, 1).alias("at"))
    rows = df.withColumn("back", permute.unpermuted("at", n, 5, 1)).orderBy("id").collect()
    assert [r["at"] for r in rows] == [plain_permuted(i, n, 5, 1) for i in range(n)]
    assert sorted(r["at"] for r in rows) == list(range(n)) == [r["back"] for r in rows]


def test_permutation_of_very_many(spark):
    n = 10**14 + 7
    df = spark.range(2000).select((F.col("id") * 50_000_000_003).alias("p")).select("p", permute.permuted("p", n, "k").alias("at"))
    rows = df.withColumn("back", permute.unpermuted("at", n, "k")).collect()
    assert all(r["back"] == r["p"] and 0 <= r["at"] < n and r["at"] == plain_permuted(r["p"], n, "k") for r in rows)
    # About as many as chance puts into each tenth.
    tenths = np.bincount([r["at"] * 10 // n for r in rows], minlength=10)
    assert tenths.min() > 140 and tenths.max() < 260


def test_positions_out_of_range_fail(spark):
    assert spark.range(1).select(permute.permuted(F.lit(None).cast("long"), 5, 1)).first()[0] is None
    for bad in (-1, 5):
        with pytest.raises(Exception, match="not one of 5 positions"):
            spark.range(1).select(permute.permuted(F.lit(bad), 5, 1).alias("at")).collect()


def test_epochs_differ_and_nothing_moves(spark):
    df = spark.range(500).withColumnRenamed("id", "position")
    epochs = [batches.epoch_batches(df, "position", 64, 3, e, 500) for e in range(4)]
    orders = [tuple(r["shuffled"] for r in e.orderBy("position").collect()) for e in epochs]
    assert len(set(orders)) == 4
    plan = epochs[1]._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan and "Sort" not in plan
    assert [r["count"] for r in epochs[2].groupBy("batch_id").count().orderBy("batch_id").collect()] == [64] * 7 + [52]


@pytest.fixture(scope="module")
def records(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(240, 3))
    rows = [(i, x[i].tolist(), [float(x[i, 0] * x[i, 1])]) for i in range(240)]
    return spark.createDataFrame(rows, "column_id bigint, x array<double>, y array<double>").repartition(3).persist()


def fit(records, **more):
    return learn.fit_mlp(records, "x", "y", "column_id", hidden=(4,), lr=0.02, seed=3, **{"epochs": 2, "batch": 48, "world": 4, **more})


def jobs_of(spark, work):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "training")
    try:
        work()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_do_not_follow_the_number_of_batches(spark, records):
    counts = []
    for batch, world in ((120, 2), (24, 2), (2, 1)):
        stored = learn.store_batches(records, "column_id", batch, 3, world)
        assert stored.n_batches == 240 // batch
        counts.append(jobs_of(spark, lambda stored=stored: fit(records, batch=batch, stored=stored, epochs=1)))
        stored.remove(spark)
    assert counts[0] == counts[1] == counts[2]


def test_steps_as_jobs_give_the_same_weights(records):
    one, other = fit(records, batch=120, steps_as_jobs=True), fit(records, batch=120)
    assert [h[:2] for h in one.history] == [h[:2] for h in other.history]
    for a, b in zip(one.weights, other.weights):
        np.testing.assert_allclose(a, b, rtol=1e-9)
    with pytest.raises(ValueError):
        fit(records, reshuffle=True, steps_as_jobs=True)


def test_weights_do_not_follow_the_number_of_tasks(spark, records, monkeypatch):
    """Also with sums that are exchanged in many parts."""
    whole = fit(records, epochs=1, batch=120)
    for tasks, values in ((1, 1 << 22), (3, 50)):
        monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda self, n=tasks: n))
        monkeypatch.setattr(learn, "EXCHANGE", values)
        other = fit(records.repartition(5), epochs=1, batch=120)
        assert [h[3] for h in other.history] == [h[3] for h in whole.history] == [120] * 2
        for a, b in zip(other.weights, whole.weights):
            np.testing.assert_allclose(a, b, rtol=1e-9)


def test_a_walk_equals_single_steps(spark, records):
    """The stage takes the steps that ``step_gradient`` takes one job at a time, penalties and dropout included."""
    start = learn.Network(learn.initial_weights([3, 5, 1], 1), dropout=0.3, l1=1e-3, l2=1e-2)
    stored = learn.store_batches(records, "column_id", 80, 3, 2)
    columns = {"x": "x", "y": "y"}
    net = learn._fit(records, start, columns, "column_id", 1, 80, 0.05, 3, 2, 1, stored, None)
    single, optimiser = start, learn.Adam(0.05)
    for step in range(3):
        loss, slopes, n = learn.step_gradient(stored.rows(spark, step), single, columns, 3, step, "column_id")
        assert (loss, n) == (pytest.approx(net.history[step][2]), 80)
        single = learn.replace(single, weights=optimiser.move(single.weights, slopes))
    stored.remove(spark)
    for a, b in zip(net.weights, single.weights):
        np.testing.assert_allclose(a, b, rtol=1e-9)


def test_reshuffled_epochs_follow_the_permutation(spark, records):
    net = fit(records, epochs=3, reshuffle=True, batch=80, world=2)
    stored = learn.store_batches(records, "column_id", 80, 3, 2)
    rows = stored.table(spark).toPandas().sort_values("position")
    stored.remove(spark)
    x, y = np.array(rows["x"].tolist()), np.array(rows["y"].tolist())
    single, optimiser, losses = learn.Network(learn.initial_weights([3, 4, 1], 3)), learn.Adam(0.02), []
    for epoch in range(3):
        place = np.array([plain_permuted(p, 240, 3, epoch) if epoch else p for p in range(240)])
        for k in range(3):
            mine = place // 2 // 40 == k
            loss, slopes = learn.gradient(single, x[mine], {"y": y[mine]})
            losses.append(loss / 80)
            single.weights = optimiser.move(single.weights, [g / 80 for g in slopes])
    assert [h[2] for h in net.history] == pytest.approx(losses)


def test_training_goes_on_where_it_stopped(records):
    for reshuffle in (False, True):
        more = {"reshuffle": reshuffle, "batch": 80, "world": 1}
        whole = fit(records, epochs=3, **more)
        part = fit(records, resume=fit(records, epochs=1, **more), epochs=2, **more)
        assert [h[:2] for h in part.history] == [h[:2] for h in whole.history]
        for a, b in zip(part.weights, whole.weights):
            np.testing.assert_allclose(a, b, rtol=1e-9)
