"""Running ranks and asynchronous halving against plain versions, and a live search that never waits."""

import random
import threading

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridframe.operators import ranks, trials
from gridframe.plans import search
from gridframe.session import scratch_path


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=70))
def test_smaller_before(values):
    expected = [sum(b < a for b in values[:i]) for i, a in enumerate(values)]
    assert ranks.smaller_before(np.array(values, dtype="int64")).tolist() == expected


@pytest.mark.parametrize("block", [3, 16, None])
def test_running_rank(spark, block):
    rng = random.Random(block or 0)
    rows = [(k, i, rng.choice([0.5, 1.0, 2.0, rng.random(), None])) for k, i in enumerate(rng.sample(range(1000), 60))]
    df = spark.createDataFrame(rows, "k long, at long, score double").repartition(4)
    order = [trials._best_first("score", "min")]
    got = {r["k"]: (r["arrived"], r["rank"]) for r in ranks.running_rank(df, ["at"], order, block=block).collect()}
    rows.sort(key=lambda r: r[1])
    worse = lambda s: float("inf") if s is None else s
    for i, (k, _, score) in enumerate(rows):
        assert got[k] == (i + 1, 1 + sum(worse(s) <= worse(score) for _, _, s in rows[:i]))


def test_running_rank_of_nothing(spark):
    empty = spark.createDataFrame([], "k long, at long, score double")
    assert ranks.running_rank(empty, ["at"], ["score"]).count() == 0


def plain_stops(rows, max_t, grace, factor, sign):
    """rows: (trial, arrival, iteration, score)."""
    rows = [r for r in rows if r[2] <= max_t]
    value = lambda s: float("inf") if s is None or s != s else sign * s
    stops, alive = {}, {r[0] for r in rows}
    for rung in trials.milestones(max_t, grace, factor):
        here, seen = {}, []
        for trial, _, iteration, score in sorted(rows, key=lambda r: r[1]):
            if iteration >= rung and trial in alive and trial not in here:
                better = sum(s <= value(score) for s in seen)
                seen.append(value(score))
                here[trial] = (better < -(-len(seen) // factor), iteration)
        stops |= {t: i for t, (on, i) in here.items() if not on}
        alive = {t for t, (on, _) in here.items() if on}
    last = {}
    for trial, _, iteration, _ in rows:
        last[trial] = max(last.get(trial, 0), iteration)
    return {**last, **stops}


@pytest.mark.parametrize("mode", ["min", "max"])
def test_async_stop_judges_arrivals(spark, mode):
    rng = random.Random(5)
    rows, clock = [], iter(rng.sample(range(10_000), 2000))
    for trial in range(40):
        at = sorted(next(clock) for _ in range(rng.choice([1, 3, 8, 12])))
        steps = sorted(rng.sample(range(1, 15), len(at)))
        rows += [(trial, a, i, rng.choice([None, float("nan"), 1.0, rng.random()])) for a, i in zip(at, steps)]
    df = spark.createDataFrame(rows, "trial_id long, at long, iteration int, score double").repartition(5)
    got = {r["trial_id"]: r["stopped_at"] for r in trials.async_stop(df, 12, 2, 2, "at", mode=mode).collect()}
    assert got == plain_stops(rows, 12, 2, 2, 1 if mode == "min" else -1)


def test_live_search_does_not_wait_for_the_slowest(spark):
    """Trial 0 ends its first leg only when all others are through: a common milestone would never be reached."""
    others, lock, legs = threading.Event(), threading.Lock(), []

    def advance(params, state, done, until):
        if params["loss"] == 0.0 and done == 0:
            assert others.wait(60)
        with lock:
            legs.append((params["loss"], until))
            if len({x for x, _ in legs if x != 0.0}) == 5 and (1.0, 8) in legs:
                others.set()
        return (state or 0) + 1, [(i, "loss", params["loss"] + 1 / i) for i in range(done + 1, until + 1)]

    df = spark.createDataFrame([(i, float(i)) for i in range(6)], "trial_id long, loss double")
    history = search.train_async(df, advance, scratch_path(spark, "async"), 8, 2, 2, "loss", at_once=2)
    last = {r["trial_id"]: r["i"] for r in history.groupBy("trial_id").agg({"iteration": "max"}).toDF("trial_id", "i").collect()}
    # The first to arrive goes on whatever its loss; trial 0 comes last and is the best of all.
    assert last[1] == 8 and last[0] == 8
    assert all(last[t] in (2, 4, 8) for t in range(6)) and min(last.values()) == 2
    assert history.count() == sum(last.values())


def test_live_search_equals_table_form(spark):
    """One trial at a time: the live decisions are those over the history of all reports in that order."""
    rng = random.Random(3)
    scores = {t: [rng.choice([float("nan"), rng.random()]) for _ in range(9)] for t in range(12)}

    def advance(params, state, done, until):
        return None, [(i, "loss", scores[params["t"]][i - 1]) for i in range(done + 1, until + 1)]

    df = spark.createDataFrame([(t, t) for t in range(12)], "trial_id long, t long")
    history = search.train_async(df, advance, scratch_path(spark, "async"), 9, 1, 3, "loss", at_once=1)
    live = {r[0]: r[1] for r in history.groupBy("trial_id").agg({"iteration": "max"}).collect()}
    rows, at = [], 0
    for trial in range(12):  # a trial that goes on is taken up before the next begins
        for i in range(9):
            rows.append((trial, at, i + 1, scores[trial][i]))
            at += 1
    assert live == plain_stops(rows, 9, 1, 3, 1)


def test_selection_equals_sorting(spark):
    rng = random.Random(8)
    values = [None, float("nan"), 0.0, -0.0, float("inf"), -float("inf"), 1e-310, -2.5, -2.5, 2.5] + [rng.choice([rng.gauss(0, 9), 1.5]) for _ in range(90)]
    rng.shuffle(values)
    df = spark.createDataFrame([(i * 1_000_003 - 7, v) for i, v in enumerate(values)], "k long, v double").repartition(4).persist()
    rank = lambda r: (float("inf") if r["v"] is None or r["v"] != r["v"] else r["v"] + 0.0, r["v"] is None or r["v"] != r["v"], r["k"])
    rows = sorted(df.collect(), key=rank)
    keys = [ranks.order_bits(df["v"]), df["k"]]
    for count in (0, 1, 2, 3, 5, 11, 37, 60, 98, 99, 100, 200):
        got = {r["k"] for r in df.where(ranks.among_smallest(df, keys, count)).collect()}
        assert got == {r["k"] for r in rows[:count]}


def test_early_stop_sorts_nothing(spark, monkeypatch):
    """No range exchange: the best are selected."""
    df = spark.createDataFrame([(t, i, float(t * 7 % 13)) for t in range(40) for i in range(1, 5)], "trial_id long, iteration int, score double")
    plans, cut = [], trials.cut
    monkeypatch.setattr(trials, "cut", lambda f: plans.append(f._jdf.queryExecution().executedPlan().toString()) or cut(f))
    stopped = trials.early_stop(df, 4, 1, 2)
    plans.append(stopped._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 3 and not any("rangepartitioning" in p.lower() for p in plans)
    assert sorted(r["stopped_at"] for r in stopped.collect()) == [1] * 20 + [2] * 10 + [4] * 10
    with pytest.raises(TypeError):
        trials.early_stop(df.withColumn("trial_id", df["trial_id"].cast("string")), 4, 1, 2)
