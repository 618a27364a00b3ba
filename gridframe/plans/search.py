"""Running trials: one Spark task per trial for an objective of its own, or one training job per trial."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from typing import Any

import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.operators.trials import milestones
from gridframe.plans import learn

HISTORY = "trial_id bigint, iteration bigint, name string, value double"

# Rows of history a task hands over at a time.
CHUNK = 10_000


def run_trials(
    trials: DataFrame,
    objective: Callable[..., Iterable[dict[str, float]]],
    params: Sequence[str],
    fixed: dict[str, Any] | None = None,
    trial: str = "trial_id",
) -> DataFrame:
    """History of every trial: ``objective(**params, **fixed)`` yields one dictionary of metrics per iteration.

    Trials are spread over tasks by their number and run in as many tasks at a time as there are free slots. Reports
    leave the task as they come, so a long history is never held whole.
    """
    fixed, names = fixed or {}, list(params)

    def run(frames):
        held: list[tuple] = []
        columns = ["trial_id", "iteration", "name", "value"]
        for frame in frames:
            for number, *values in frame.itertuples(index=False, name=None):
                for i, metrics in enumerate(objective(**dict(zip(names, values)), **fixed), start=1):
                    held += [(number, i, key, float(value)) for key, value in metrics.items()]
                    if len(held) >= CHUNK:
                        yield pd.DataFrame(held, columns=columns)
                        held = []
        if held:
            yield pd.DataFrame(held, columns=columns)

    spread = trials.select(F.col(trial).cast("bigint").alias("trial_id"), *names).repartition("trial_id")
    return spread.mapInPandas(run, HISTORY)


def train_trials(
    trials: DataFrame,
    fit: Callable[[dict[str, Any]], Iterable[tuple[int, str, float]]],
    at_once: int = 4,
    trial: str = "trial_id",
) -> DataFrame:
    """History of trials that each train over the whole data.

    ``fit(params)`` runs distributed training and gives (iteration, metric name, value). The trials are a short list of
    settings; ``at_once`` of them have their jobs in the cluster at the same time.
    """
    spark = trials.sparkSession
    settings = [row.asDict() for row in trials.collect()]

    def one(params: dict[str, Any]) -> list[tuple]:
        number = params.pop(trial)
        return [(int(number), int(i), name, float(value)) for i, name, value in fit(params)]

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        runs = list(pool.map(inheritable_thread_target(spark)(one), settings))
    return spark.createDataFrame([report for run in runs for report in run], HISTORY)


def train_until_stopped(
    trials: DataFrame,
    advance: Callable[[dict[str, Any], Any, int, int], tuple[Any, Iterable[tuple[int, str, float]]]],
    path: str,
    max_t: int,
    grace: int,
    factor: int,
    metric: str,
    mode: str = "min",
    at_once: int = 4,
    trial: str = "trial_id",
) -> DataFrame:
    """History of trials under successive halving that ends losing trials while the others go on.

    ``advance(params, state, done, until)`` trains a trial from iteration ``done`` to ``until``, starting from the state
    it returned before (None at first), and gives the new state and its reports (iteration, name, value). At every
    milestone the best 1 / factor (rounded up) of the live trials go on, by the metric of their last report; trials
    without one, or with NaN, rank last, and ties go to the lower number. The driver holds the settings and states of
    live trials, a short list; reports are appended to the table at ``path`` round by round, and that table is returned.
    """
    spark = trials.sparkSession
    live = {int(row[trial]): (row.asDict(), None) for row in trials.collect()}
    done = 0
    for until in [*milestones(max_t, grace, factor), max_t]:

        def one(item: tuple) -> tuple:
            number, (params, state) = item
            state, reports = advance({k: v for k, v in params.items() if k != trial}, state, done, until)
            return number, params, state, [(number, int(i), name, float(value)) for i, name, value in reports]

        with ThreadPoolExecutor(max_workers=at_once) as pool:
            results = list(pool.map(inheritable_thread_target(spark)(one), live.items()))
        spark.createDataFrame([r for *_, reports in results for r in reports], HISTORY).write.mode("append").parquet(path)
        scores = {}
        for number, *_, reports in results:
            values = [(i, value) for _, i, name, value in reports if name == metric and value == value]
            score = max(values)[1] if values else float("inf")
            scores[number] = score if mode == "min" or not values else -score
        kept = sorted(scores, key=lambda n: (scores[n], n))
        kept = kept if until == max_t else kept[: -(-len(kept) // factor)]
        live = {number: (params, state) for number, params, state, _ in results if number in set(kept)}
        done = until
    return spark.read.schema(HISTORY).parquet(path)


def train_async(
    trials: DataFrame,
    advance: Callable[[dict[str, Any], Any, int, int], tuple[Any, Iterable[tuple[int, str, float]]]],
    path: str,
    max_t: int,
    grace: int,
    factor: int,
    metric: str,
    mode: str = "min",
    at_once: int = 4,
    trial: str = "trial_id",
) -> DataFrame:
    """History of trials under asynchronous halving: each is judged when it reaches a milestone, and none waits.

    ``advance`` is that of :func:`train_until_stopped`. When a trial comes to a milestone, its last metric is ranked
    among those that came there before: it goes on at once while it is among the best 1 / factor (rounded up) so far,
    and its place is free for the next trial otherwise. Trials that go on come before trials not yet begun. Null and NaN
    rank last, of equal metrics the earlier one is better. Reports are added below ``path``, a folder a leg, and read
    from there; the driver holds settings and states of trials under way, and one number per milestone
    reached.
    """
    spark = trials.sparkSession
    stops = [*milestones(max_t, grace, factor), max_t]
    reached: list[list[float]] = [[] for _ in stops]
    waiting = [(int(row[trial]), row.asDict(), None, 0) for row in trials.orderBy(trial, ascending=False).collect()]
    # Writers at the same time need folders of their own: the first to commit clears the others' unfinished files.
    spark.createDataFrame([], HISTORY).write.parquet(f"{path}/begin")

    def leg(number: int, params: dict[str, Any], state: Any, rung: int) -> tuple:
        done = stops[rung - 1] if rung else 0
        state, reports = advance({k: v for k, v in params.items() if k != trial}, state, done, stops[rung])
        rows = [(number, int(i), name, float(value)) for i, name, value in reports]
        spark.createDataFrame(rows, HISTORY).coalesce(1).write.parquet(f"{path}/{number}-{stops[rung]}")
        return number, params, state, rung, rows

    def goes_on(rung: int, rows: list[tuple]) -> bool:
        last = max(((i, value) for _, i, name, value in rows if name == metric), key=lambda r: r[0], default=(0, float("nan")))[1]
        score = float("inf") if last != last else last if mode == "min" else -last
        better = bisect_right(reached[rung], score)
        insort(reached[rung], score)
        return better < -(-len(reached[rung]) // factor)

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = set()
        while waiting or running:
            while waiting and len(running) < at_once:
                running.add(pool.submit(inheritable_thread_target(spark)(leg), *waiting.pop()))
            ready, running = wait(running, return_when=FIRST_COMPLETED)
            for future in ready:
                number, params, state, rung, rows = future.result()
                if rung + 1 < len(stops) and goes_on(rung, rows):
                    waiting.append((number, params, state, rung + 1))
    return spark.read.schema(HISTORY).option("recursiveFileLookup", "true").parquet(path)


def search_flux_heads(
    trials: DataFrame,
    df: DataFrame,
    x: str,
    targets: dict[str, str],
    row_id: str,
    validation: DataFrame,
    path: str,
    levels: int,
    stats: DataFrame | None = None,
    max_t: int = 50,
    grace: int = 10,
    factor: int = 4,
    batch: int = 256,
    seed: int = 42,
    world: int = 1,
    dropout: float = 0.5,
    at_once: int = 4,
) -> DataFrame:
    """History of the flux model's search (``train_loss``, ``val_loss``, ``val_hr_sw_mae``, ``val_hr_lw_mae`` by epoch).

    ``trials`` hold ``trial_id`` and what :func:`gridframe.operators.trials.flux_space` draws; a true ``dropout`` there
    takes the rate given here. Trials are judged by ``val_loss`` under asynchronous halving, an epoch being an iteration,
    and all train on rows that are stored once.
    """
    spark = df.sparkSession
    kept = learn.store_batches(df.select(row_id, x, *targets.values()), row_id, batch, seed, world)

    def advance(params: dict[str, Any], state: Any, done: int, until: int) -> tuple:
        rate = dropout if params["dropout"] else 0.0
        net = learn.fit_flux_heads(
            df, x, targets, row_id, levels, stats, int(params["width"]), int(params["depth"]), params["l1"], params["l2"], rate,
            params["learning_rate"], until - done, batch, seed, world, stored=kept, validation={"val": validation},
            activation=params["activation"], resume=state,
        )
        return net, [(epoch + 1, name, value) for epoch, name, value in net.reports if epoch >= done]

    try:
        return train_async(trials, advance, path, max_t, grace, factor, "val_loss", at_once=at_once)
    finally:
        kept.remove(spark)
