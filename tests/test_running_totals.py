"""Running scores without a join of as many rows as there are trials."""

import pytest
from pyspark.sql import functions as F

from gridframe.operators import trials


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _toy(spark, n: int):
    return trials.toy_objective(spark.range(n).selectExpr("id AS trial_id", "2 + id % 5 AS p", "id % 2 = 0 AS cumulate"), 12, cumulate="cumulate")


def test_toy_objective_joins_nothing(spark):
    history = _toy(spark, 100)
    assert "Join" not in _plan(history) and "Broadcast" not in _plan(history)
    for r in history.collect():
        first = r.iteration if r.trial_id % 2 else 1
        assert r.score == pytest.approx(sum(1 / (r.p + i - 1) for i in range(first, r.iteration + 1)))


@pytest.mark.parametrize("block", [1, 7, 4096])
def test_running_score_over_blocks(spark, block):
    rows = [(t, i, "a", None if (t, i) == (1, 5) else float(t + i)) for t in (1, 2) for i in range(1, 30)]
    rows += [(None, 1, None, 2.0), (None, 2, "b", 3.0), (3, None, "c", 1.0)]
    history = spark.createDataFrame(rows, "trial_id long, iteration long, kind string, score double")
    out = trials.running_score(history, "trial_id", "iteration", "score", block=block)
    assert out.columns == ["trial_id", "iteration", "kind", "score", "running"] and out.count() == len(rows)
    got = {(r.trial_id, r.iteration): r.running for r in out.where(F.col("score").isNotNull()).collect()}
    for t, i, _, score in rows:
        if score is not None:
            assert got[t, i] == pytest.approx(sum(s for u, j, _, s in rows if u == t and s is not None and (j is None or j <= i)))


def test_best_trial_joins_nothing(spark):
    best = trials.best_trial(_toy(spark, 100), "score", ["p", "cumulate"])
    assert "Join" not in _plan(best) and "Broadcast" not in _plan(best)
    row = best.first()
    assert (row.trial_id, row.p, row.cumulate, row.score) == (9, 6, False, pytest.approx(1 / 17))
