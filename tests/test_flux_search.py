"""The flux model's activations, held-out errors and its search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridframe.operators import trials
from gridframe.plans import learn, search
from gridframe.session import scratch_path

LEVELS = 4
TARGETS = {k: k for k in ("sw", "lw", "hr_sw", "hr_lw", "pressure")}


@pytest.mark.parametrize("kind", ["silu", "swish", "relu", "tanh", "sigmoid"])
def test_slopes_of_activations(kind):
    z = np.array([-3.0, -0.4, 0.3, 2.0])
    value, slope = learn.activated(kind, z)
    up, down = (learn.activated(kind, z + d)[0] for d in (1e-6, -1e-6))
    np.testing.assert_allclose(slope, (up - down) / 2e-6, atol=1e-8)
    with pytest.raises(ValueError):
        learn.activated("other", z)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    found = []
    for i in range(48):
        x = rng.normal(size=3)
        flux = np.outer(np.linspace(1, 2, LEVELS), [x[0], 0.5 * x[1]])
        pressure = np.linspace(100.0, 1000.0, LEVELS)
        rate, _ = learn.heating(flux[None], pressure[None])
        found.append((i, x.tolist(), flux.ravel().tolist(), flux.ravel().tolist(), rate[0].tolist(), rate[0].tolist(), pressure.tolist()))
    kind = "array<double>"
    schema = f"column_id bigint, x {kind}, sw {kind}, lw {kind}, hr_sw {kind}, hr_lw {kind}, pressure {kind}"
    return spark.createDataFrame(found, schema).persist()


def test_held_out_errors_are_those_of_scoring(rows):
    net = learn.Network(learn.initial_weights([3, 5, 4 * LEVELS], 2), levels=LEVELS, activation="tanh")
    found = learn.held_out_losses(rows, net, {"x": "x", **TARGETS})
    losses, absolute = learn.evaluate_flux_heads(rows, net, "x", TARGETS)
    assert found["loss"] == pytest.approx(losses.first()["loss"])
    mae = {r["output"]: r["mae"] for r in absolute.collect()}
    assert (found["hr_sw_mae"], found["hr_lw_mae"]) == (pytest.approx(mae["hr_sw"]), pytest.approx(mae["hr_lw"]))


def test_search_runs_the_drawn_trials(spark, rows):
    """Each trial's reports are those of a fit with its settings; the first to arrive goes on."""
    space = {**trials.flux_space(), "width": trials.choice([4, 8]), "depth": trials.randint(1, 3), "learning_rate": trials.loguniform(1e-3, 1e-1)}
    drawn = trials.sample_space(spark.range(3).withColumnRenamed("id", "trial_id"), space, seed=2)
    held = rows.where("column_id % 4 = 0")
    history = search.search_flux_heads(
        drawn, rows, "x", TARGETS, "column_id", held, scratch_path(spark, "flux"), LEVELS, max_t=2, grace=1, factor=2, batch=48, at_once=1
    )
    assert {r["name"] for r in history.select("name").distinct().collect()} == {"train_loss", "val_loss", "val_hr_sw_mae", "val_hr_lw_mae"}
    last = {r["trial_id"]: r["n"] for r in history.groupBy("trial_id").agg(F.max("iteration").alias("n")).collect()}
    assert last[0] == 2 and set(last) == {0, 1, 2}
    params = {r["trial_id"]: r for r in drawn.collect()}
    one = params[0]
    net = learn.fit_flux_heads(
        rows, "x", TARGETS, "column_id", LEVELS, width=one["width"], depth=one["depth"], l1=one["l1"], l2=one["l2"], dropout=0.5 * one["dropout"],
        lr=one["learning_rate"], epochs=2, batch=48, validation={"val": held}, activation=one["activation"],
    )
    got = {(r["iteration"] - 1, r["name"]): r["value"] for r in history.where("trial_id = 0").collect()}
    assert got == {(e, name): pytest.approx(value) for e, name, value in net.reports}
