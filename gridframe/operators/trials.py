"""Hyper-parameter trials as tables: sampling, histories, early stopping, the best trial."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.functions.arrays import int_div
from gridframe.functions.draws import normal_draw, uniform_draw
from gridframe.operators.index import with_group_position
from gridframe.operators.ranks import among_smallest, order_bits, running_rank
from gridframe.session import cut


@dataclass
class Draw:
    """How one hyper-parameter is drawn; see the functions below."""

    kind: str
    args: tuple[Any, ...]


def uniform(low: float, high: float) -> Draw:
    return Draw("uniform", (low, high))


def quniform(low: float, high: float, q: float) -> Draw:
    return Draw("quniform", (low, high, q))


def loguniform(low: float, high: float) -> Draw:
    return Draw("loguniform", (low, high))


def qloguniform(low: float, high: float, q: float) -> Draw:
    return Draw("qloguniform", (low, high, q))


def randn(mean: float = 0.0, std: float = 1.0) -> Draw:
    return Draw("randn", (mean, std))


def qrandn(mean: float, std: float, q: float) -> Draw:
    return Draw("qrandn", (mean, std, q))


def randint(low: int, high: int) -> Draw:
    return Draw("randint", (low, high))


def qrandint(low: int, high: int, q: int) -> Draw:
    return Draw("qrandint", (low, high, q))


def lograndint(low: int, high: int) -> Draw:
    return Draw("lograndint", (low, high))


def qlograndint(low: int, high: int, q: int) -> Draw:
    return Draw("qlograndint", (low, high, q))


def choice(values: Sequence[Any]) -> Draw:
    return Draw("choice", (list(values),))


def sample_from(expression: Callable[[], Column]) -> Draw:
    """A value computed from the parameters named before it."""
    return Draw("sample_from", (expression,))


def grid_search(values: Sequence[Any]) -> Draw:
    return Draw("grid_search", (list(values),))


def flux_space() -> dict[str, Draw]:
    """What the flux model's search draws. The bounds and choices are fixed values."""
    return {
        "learning_rate": loguniform(1e-6, 1e-4),
        "width": choice([128, 256, 512]),
        "depth": randint(1, 10),
        "l1": loguniform(1e-5, 1e-2),
        "l2": loguniform(1e-5, 1e-2),
        "dropout": choice([True, False]),
        "activation": choice(["swish"]),
    }


def _value(draw: Draw, trial: str, seed, name: str) -> Column:
    u = uniform_draw(trial, seed, name)
    kind, args = draw.kind, draw.args
    quantum = None
    if kind.startswith("q"):
        kind, args, quantum = kind[1:], args[:-1], args[-1]
    if kind == "choice":
        values = F.array(*[F.lit(v) for v in args[0]])
        return F.element_at(values, (F.floor(u * len(args[0])) + 1).cast("int"))
    if kind == "sample_from":
        return args[0]()
    if kind == "randn":
        value = F.lit(float(args[0])) + F.lit(float(args[1])) * normal_draw(trial, seed, name)
    elif kind in ("loguniform", "lograndint"):
        low, high = F.log(F.lit(float(args[0]))), F.log(F.lit(float(args[1])))
        value = F.exp(low + u * (high - low))
    else:
        value = F.lit(args[0]) + u * F.lit(args[1] - args[0])
    whole = kind in ("randint", "lograndint")
    if whole:
        value = F.floor(value)
    if quantum is not None:
        value = F.floor(value / F.lit(quantum) + F.lit(0.5)) * F.lit(quantum)
    return value.cast("bigint") if whole else value.cast("double")


def sample_space(trials: DataFrame, space: dict[str, Draw], trial: str = "trial_id", seed=0) -> DataFrame:
    """Every trial row with one value per hyper-parameter, the same for the same seed.

    Draws are projections of the trial number. A grid parameter turns each row into one row per value; several grids
    give every combination once, numbered by ``grid_id``.
    """
    combos = 1
    out = trials.withColumn("grid_id", F.lit(0).cast("bigint"))
    for name, draw in space.items():
        if draw.kind == "grid_search":
            values = draw.args[0]
            picked = F.posexplode(F.array(*[F.lit(v) for v in values])).alias("_i", name)
            out = out.select("*", picked)
            out = out.withColumn("grid_id", F.col("grid_id") * len(values) + F.col("_i")).drop("_i")
            combos *= len(values)
        else:
            out = out.withColumn(name, _value(draw, trial, seed, name))
    return out if combos > 1 else out.drop("grid_id")


def toy_objective(trials: DataFrame, iterations: int, trial: str = "trial_id", p: str = "p", cumulate: str | None = None) -> DataFrame:
    """History of score = 1 / p, p growing by one each iteration; cumulated where the trial says so."""
    steps = F.explode(F.sequence(F.lit(1), F.lit(iterations))).alias("iteration")
    history = trials.select(trial, p, *([cumulate] if cumulate else []), steps)
    history = history.withColumn("score", F.lit(1.0) / (F.col(p) + F.col("iteration") - 1))
    if cumulate:
        running = running_score(history, trial, "iteration", "score")
        history = running.withColumn("score", F.when(F.col(cumulate), F.col("running")).otherwise(F.col("score"))).drop("running")
    return history


def running_score(
    history: DataFrame, trial: str, iteration: str, score: str, name: str = "running", block: int = 4096
) -> DataFrame:
    """Sum of the scores of a trial up to each iteration.

    Iterations are cut into blocks: each block is summed up to each row on its own, then the total of the blocks before
    it is added. One trial with most of the rows is thus spread over many tasks. That total goes ahead of its block as a
    row of its own: there are as many totals as trials at least, and a join of them might be broadcast.
    """
    cut_up = history.withColumn("_block", int_div(iteration, block))
    totals = cut_up.groupBy(trial, "_block").agg(F.sum(score).alias("_t"))
    before = F.sum("_t").over(W.partitionBy(trial).orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    totals = totals.select(trial, "_block", F.coalesce(before, F.lit(0.0)).alias("_before"))
    report = F.col("_before").isNull()
    up_to = W.partitionBy(trial, "_block").orderBy(report, iteration).rowsBetween(W.unboundedPreceding, 0)
    summed = F.first("_before").over(up_to) + F.sum(score).over(up_to)
    out = cut_up.unionByName(totals, allowMissingColumns=True).withColumn(name, summed)
    return out.where(report).select(*history.columns, name)


def reports(history: DataFrame, names: Sequence[str], trial: str = "trial_id", iteration: str = "iteration") -> DataFrame:
    """Metric reports (trial, iteration, name, value) as one row per iteration with a column per metric."""
    values = [F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names]
    return history.groupBy(trial, iteration).agg(*values)


def rung_rank(reported: DataFrame, rung: str, metric: str, trial: str = "trial_id", mode: str = "min", name: str = "rank") -> DataFrame:
    """Rank of each trial among those that reached the same rung; equal metrics are ranked by trial, and null or NaN
    ones last."""
    placed = with_group_position(reported, [rung], [_best_first(metric, mode), F.col(trial)], name)
    return placed.withColumn(name, F.col(name) + 1)


def _best_first(metric: str, mode: str) -> Column:
    """Sort order by a metric, without a value last."""
    value = F.col(metric).cast("double")
    value = F.when(~F.isnan(value), value)
    return value.asc_nulls_last() if mode == "min" else value.desc_nulls_last()


def milestones(max_t: int, grace: int, factor: int) -> list[int]:
    """Iterations at which trials are compared: grace, grace * factor, ... below max_t."""
    found, t = [], grace
    while t < max_t:
        found.append(t)
        t *= factor
    return found


def early_stop(
    history: DataFrame,
    max_t: int,
    grace: int,
    factor: int,
    metric: str = "score",
    trial: str = "trial_id",
    iteration: str = "iteration",
    mode: str = "min",
) -> DataFrame:
    """Iteration at which each trial is stopped by successive halving: (trial, stopped_at).

    At every milestone the best 1 / factor (rounded up) of the trials still running go on, judged by their first report
    at or after it; null and NaN metrics rank last, and equal ones by trial number. A trial that reports less stops by
    itself at its last iteration. There are log(max_t) rounds; each selects from the written reports of the trials that
    the round before left.
    """
    if not isinstance(history.schema[trial].dataType, T.IntegralType):
        raise TypeError(f"{trial} is no whole number")
    last = history.where(F.col(iteration) <= max_t).groupBy(trial).agg(F.max(iteration).alias("_last"))
    alive = last.select(trial)
    stopped = None
    for rung in milestones(max_t, grace, factor):
        due = history.where(F.col(iteration).between(rung, max_t)).groupBy(trial)
        here = due.agg(F.min_by(F.struct(F.col(metric), F.col(iteration)), iteration).alias("_r"))
        here = here.select(trial, F.col(f"_r.{metric}").alias(metric), F.col(f"_r.{iteration}").cast("bigint").alias("_at_iteration"))
        here = cut(here.join(alive, trial, "left_semi"))
        value = F.col(metric).cast("double")
        best = [order_bits(value if mode == "min" else -value), F.col(trial).cast("bigint")]
        judged = here.withColumn("_keep", among_smallest(here, best, -(-here.count() // factor)))
        out = judged.where(~F.col("_keep")).select(trial, F.col("_at_iteration").alias("stopped_at"))
        stopped = out if stopped is None else stopped.unionByName(out)
        alive = judged.where("_keep").select(trial)
    ended = last.select(trial, F.col("_last").cast("bigint").alias("stopped_at"))
    if stopped is None:
        return ended
    return stopped.unionByName(ended.join(stopped, trial, "left_anti"))


def async_stop(
    history: DataFrame,
    max_t: int,
    grace: int,
    factor: int,
    arrival: str,
    metric: str = "score",
    trial: str = "trial_id",
    iteration: str = "iteration",
    mode: str = "min",
) -> DataFrame:
    """Iteration at which each trial is stopped by asynchronous halving: (trial, stopped_at).

    A trial is judged the moment it reaches a milestone, against the trials that reached it before: by its first report
    (in the order of ``arrival``, which is unique) at or after the milestone, it goes on while it is among the best
    1 / factor (rounded up) of those there so far, itself included. Nobody waits for later trials, and no decision is
    taken back. Of equal metrics the earlier one is better; null and NaN metrics rank last. A trial that is never
    stopped ends at its last iteration up to ``max_t``. Milestones are rounds over the trials left by the one before.
    """
    due = history.where(F.col(iteration) <= max_t)
    last = due.groupBy(trial).agg(F.max(iteration).cast("bigint").alias("stopped_at"))
    alive, stopped = last.select(trial), None
    for rung in milestones(max_t, grace, factor):
        first = due.where(F.col(iteration) >= rung).groupBy(trial).agg(F.min_by(F.struct(arrival, metric, iteration), arrival).alias("_r"))
        here = first.select(trial, "_r.*").join(alive, trial, "left_semi")
        ranked = running_rank(here, [arrival], [_best_first(metric, mode)])
        judged = cut(ranked.select(trial, F.col(iteration).cast("bigint").alias("stopped_at"), (F.col("rank") <= F.ceil(F.col("arrived") / factor)).alias("_on")))
        out = judged.where(~F.col("_on")).select(trial, "stopped_at")
        stopped = out if stopped is None else stopped.unionByName(out)
        alive = judged.where("_on").select(trial)
    return last if stopped is None else stopped.unionByName(last.join(stopped, trial, "left_anti"))


def kept_history(history: DataFrame, stops: DataFrame, trial: str = "trial_id", iteration: str = "iteration") -> DataFrame:
    """Reports made before their trial was stopped."""
    return history.join(stops, trial).where(F.col(iteration) <= F.col("stopped_at")).drop("stopped_at")


def best_trial(history: DataFrame, metric: str, params: Sequence[str], trial: str = "trial_id", mode: str = "min") -> DataFrame:
    """Configuration and result of the best report over all trials; of equal ones that of the lowest trial.

    Reports without the metric (null) are left out, and NaN is worse than any number: train and validation metrics may
    stand in different reports.
    """
    order = F.col(metric) if mode == "min" else -F.col(metric)
    best = F.min_by(F.struct(trial, *params, metric), F.struct(order, F.col(trial)))
    return history.where(F.col(metric).isNotNull()).agg(best.alias("b")).select("b.*")
