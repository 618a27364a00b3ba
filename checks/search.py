"""Hyper-parameter trials: sampling, histories, early stopping, the best trial.

Customers stand for trials where parameters are drawn; users stand for trials where histories are read, an event being
a report, its rank in time the iteration, and its value the score.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import big, registry, rnd, sql_rnd, table
from gridframe.operators import trials
from gridframe.operators.index import with_group_position

QUERIES, SQL, query = registry()

SEED = 7


def _trials(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("trial_id"))


def _history(spark, sf):
    events = table(spark, sf, "events").select(F.col("user_id").alias("trial_id"), "ts", "event_id", "event_type", F.col("value").alias("score"))
    placed = with_group_position(events, ["trial_id"], ["ts", "event_id"], "iteration")
    return placed.withColumn("iteration", F.col("iteration") + 1)


_HISTORY = """hist AS (SELECT user_id AS trial_id, event_id, event_type, value AS score,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS iteration FROM events)"""


def _u(name: str) -> str:
    return f"(CAST(('0x' || substr(md5('{SEED}-{name}-' || c_custkey), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


def _log(low: float, high: float, name: str) -> str:
    return f"exp(ln(CAST({low} AS DOUBLE)) + {_u(name)} * (ln(CAST({high} AS DOUBLE)) - ln(CAST({low} AS DOUBLE))))"


SPACE = {
    "dropout": trials.uniform(0, 1),
    "keep": trials.quniform(0.0, 1.0, 0.25),
    "lr": trials.loguniform(1e-4, 1e-1),
    "l1": trials.qloguniform(1e-2, 10.0, 0.5),
    "shift": trials.randn(1.0, 2.0),
    "qshift": trials.qrandn(0.0, 2.0, 0.5),
    "layers": trials.randint(4, 10),
    "units": trials.qrandint(16, 128, 8),
    "steps": trials.lograndint(10, 1000),
    "qsteps": trials.qlograndint(10, 1000, 10),
    "width": trials.choice([128, 256, 512]),
    "activation": trials.choice(["swish", "relu"]),
    "double_width": trials.sample_from(lambda: F.col("width").cast("bigint") * 2),
}


def _normal(name: str) -> str:
    return f"""sqrt(-2 * ln(1 - {_u(name)})) * cos(CAST(6.283185307179586 AS DOUBLE) * {_u(name + "''")})"""


@query("o1_sample_space", f"""SELECT c_custkey AS trial_id,
  {sql_rnd(_u('dropout'))} AS dropout,
  {sql_rnd(f"floor({_u('keep')} / 0.25 + 0.5) * 0.25")} AS keep,
  {sql_rnd(_log(1e-4, 1e-1, 'lr'))} AS lr,
  {sql_rnd(f"floor({_log(1e-2, 10.0, 'l1')} / 0.5 + 0.5) * 0.5")} AS l1,
  {sql_rnd(f"1 + 2 * {_normal('shift')}")} AS shift,
  {sql_rnd(f"floor(2 * {_normal('qshift')} / 0.5 + 0.5) * 0.5")} AS qshift,
  CAST(floor(4 + {_u('layers')} * 6) AS BIGINT) AS layers,
  CAST(floor(floor(16 + {_u('units')} * 112) / 8 + 0.5) * 8 AS BIGINT) AS units,
  CAST(floor({_log(10, 1000, 'steps')}) AS BIGINT) AS steps,
  CAST(floor(floor({_log(10, 1000, 'qsteps')}) / 10 + 0.5) * 10 AS BIGINT) AS qsteps,
  CAST([128, 256, 512][CAST(floor({_u('width')} * 3) AS BIGINT) + 1] AS BIGINT) AS width,
  ['swish', 'relu'][CAST(floor({_u('activation')} * 2) AS BIGINT) + 1] AS activation,
  CAST([128, 256, 512][CAST(floor({_u('width')} * 3) AS BIGINT) + 1] * 2 AS BIGINT) AS double_width
  FROM customer""")
def _(spark, sf):
    drawn = trials.sample_space(_trials(spark, sf), SPACE, seed=SEED)
    reals = ("dropout", "keep", "lr", "l1", "shift", "qshift")
    return drawn.select("trial_id", *[rnd(F.col(c)).alias(c) for c in reals],
                        *[big(c) for c in ("layers", "units", "steps", "qsteps", "width", "double_width")], "activation")


@query("o1_flux_space", f"""SELECT c_custkey AS trial_id, {sql_rnd(f'ln({_log(1e-6, 1e-4, "learning_rate")})')} AS lr,
  CAST([128, 256, 512][CAST(floor({_u('width')} * 3) AS BIGINT) + 1] AS BIGINT) AS width, CAST(floor(1 + {_u('depth')} * 9) AS BIGINT) AS depth,
  {sql_rnd(f'ln({_log(1e-5, 1e-2, "l1")})')} AS l1, {sql_rnd(f'ln({_log(1e-5, 1e-2, "l2")})')} AS l2,
  [true, false][CAST(floor({_u('dropout')} * 2) AS BIGINT) + 1] AS dropout, 'swish' AS activation FROM customer""")
def _(spark, sf):
    """The flux model's space; rates by their logarithm."""
    drawn = trials.sample_space(_trials(spark, sf), trials.flux_space(), seed=SEED)
    logs = [rnd(F.log(c)).alias(n) for n, c in (("lr", "learning_rate"), ("l1", "l1"), ("l2", "l2"))]
    return drawn.select("trial_id", *logs, big("width"), "depth", "dropout", "activation")


@query("o1_grid_search", """SELECT c_custkey AS trial_id, i * 2 + j AS grid_id, [64, 128, 256][i + 1] AS width, [true, false][j + 1] AS dropout
  FROM customer, range(3) r(i), range(2) s(j)""")
def _(spark, sf):
    space = {"width": trials.grid_search([64, 128, 256]), "dropout": trials.grid_search([True, False])}
    return trials.sample_space(_trials(spark, sf), space, seed=SEED)


_P = f"CAST(floor(2 + {_u('p')} * 5) AS BIGINT)"
_CUMULATE = f"[false, true][CAST(floor({_u('cumulate')} * 2) AS BIGINT) + 1]"
_TOY = f"""toy AS (SELECT c_custkey AS trial_id, {_P} AS p, {_CUMULATE} AS cumulate, i AS iteration, CAST(1 AS DOUBLE) / ({_P} + i - 1) AS s
    FROM customer, range(1, 13) r(i)),
  scored AS (SELECT trial_id, p, cumulate, iteration, CASE WHEN cumulate THEN sum(s) OVER (PARTITION BY trial_id ORDER BY iteration) ELSE s END AS score FROM toy)"""


def _toy_trials(spark, sf):
    space = {"cumulate": trials.choice([False, True]), "p": trials.randint(2, 7)}
    return trials.sample_space(_trials(spark, sf), space, seed=SEED)


@query("o5_toy_objective", f"WITH {_TOY} SELECT trial_id, p, cumulate, iteration, {sql_rnd('score')} AS score FROM scored")
def _(spark, sf):
    history = trials.toy_objective(_toy_trials(spark, sf), 12, cumulate="cumulate")
    return history.select("trial_id", "p", "cumulate", big("iteration"), rnd(F.col("score")).alias("score"))


_EVENTS = ["click", "purchase", "view", "signup", "error"]
_KINDS = ", ".join(f"max(score) FILTER (event_type = '{e}') AS {e}" for e in _EVENTS)


@query("o3_history", f"""WITH {_HISTORY} SELECT trial_id, iteration, {_KINDS} FROM hist GROUP BY ALL""")
def _(spark, sf):
    reported = _history(spark, sf).select("trial_id", "iteration", F.col("event_type").alias("name"), F.col("score").alias("value"))
    return trials.reports(reported, _EVENTS)


@query("w2_running_score", f"""WITH {_HISTORY} SELECT trial_id, iteration,
  {sql_rnd('sum(score) OVER (PARTITION BY trial_id ORDER BY iteration)', 4)} AS running FROM hist""")
def _(spark, sf):
    running = trials.running_score(_history(spark, sf).select("trial_id", "iteration", "score"), "trial_id", "iteration", "score", block=16)
    return running.select("trial_id", "iteration", rnd(F.col("running"), 4).alias("running"))


@query("w3_rung_rank", f"""WITH {_HISTORY} SELECT trial_id, iteration,
  row_number() OVER (PARTITION BY iteration ORDER BY score, trial_id) AS rank FROM hist""")
def _(spark, sf):
    history = _history(spark, sf).select("trial_id", "iteration", "score")
    return trials.rung_rank(history, "iteration", "score").drop("score")


def _stop_sql(max_t: int, grace: int, factor: int, mode: str = "ASC") -> str:
    """Rounds of successive halving, written out."""
    parts, alive, stops = [], "SELECT DISTINCT trial_id FROM hist", []
    for k, rung in enumerate(trials.milestones(max_t, grace, factor)):
        parts.append(f"""r{k} AS (SELECT trial_id, row_number() OVER (ORDER BY score {mode}, trial_id) AS rk, count(*) OVER () AS n
    FROM hist WHERE iteration = {rung} AND trial_id IN ({alive}))""")
        stops.append(f"SELECT trial_id, {rung} AS stopped_at FROM r{k} WHERE rk > ceil(n / CAST({factor} AS DOUBLE))")
        alive = f"SELECT trial_id FROM r{k} WHERE rk <= ceil(n / CAST({factor} AS DOUBLE))"
    parts.append(f"stops AS ({' UNION ALL '.join(stops)})")
    parts.append(f"""ended AS (SELECT trial_id, CAST(stopped_at AS BIGINT) AS stopped_at FROM stops UNION ALL
    SELECT trial_id, max(iteration) FROM hist WHERE iteration <= {max_t} AND trial_id NOT IN (SELECT trial_id FROM stops) GROUP BY 1)""")
    return ", ".join(parts)


@query("o4_early_stop", f"WITH {_HISTORY}, {_stop_sql(40, 3, 3)} SELECT trial_id, stopped_at FROM ended")
def _(spark, sf):
    return trials.early_stop(_history(spark, sf).select("trial_id", "iteration", "score"), 40, 3, 3)


@query("o4_early_stop_max", f"WITH {_HISTORY}, {_stop_sql(40, 3, 3, 'DESC')} SELECT trial_id, stopped_at FROM ended")
def _(spark, sf):
    return trials.early_stop(_history(spark, sf).select("trial_id", "iteration", "score"), 40, 3, 3, mode="max")


def _async_sql(max_t: int, grace: int, factor: int) -> str:
    """Milestones of asynchronous halving, written out: of every arrival the better ones before it are counted."""
    parts, alive, stops = [f"due AS (SELECT * FROM hist WHERE iteration <= {max_t})"], "SELECT trial_id FROM due", []
    for k, rung in enumerate(trials.milestones(max_t, grace, factor)):
        parts.append(f"""e{k} AS (SELECT trial_id, min(event_id) AS event_id, arg_min(score, event_id) AS score, arg_min(iteration, event_id) AS iteration
    FROM due WHERE iteration >= {rung} AND trial_id IN ({alive}) GROUP BY 1)""")
        parts.append(f"""r{k} AS (SELECT a.trial_id, a.iteration, count(*) + 1 - count(*) FILTER (b.event_id IS NULL) AS arrived,
    count(*) FILTER (b.score <= a.score) AS better FROM e{k} a LEFT JOIN e{k} b ON b.event_id < a.event_id GROUP BY ALL)""")
        stops.append(f"SELECT trial_id, iteration AS stopped_at FROM r{k} WHERE better >= ceil(arrived / CAST({factor} AS DOUBLE))")
        alive = f"SELECT trial_id FROM r{k} WHERE better < ceil(arrived / CAST({factor} AS DOUBLE))"
    parts.append(f"stops AS ({' UNION ALL '.join(stops)})")
    return ", ".join(parts)


@query("o4_async_halving", f"""WITH {_HISTORY}, {_async_sql(40, 3, 3)} SELECT trial_id, CAST(stopped_at AS BIGINT) AS stopped_at FROM stops
  UNION ALL SELECT trial_id, max(iteration) FROM due WHERE trial_id NOT IN (SELECT trial_id FROM stops) GROUP BY 1""")
def _(spark, sf):
    """Reports arrive in the order of their events; each trial is judged as it reaches a milestone."""
    history = _history(spark, sf).select("trial_id", "iteration", "score", "event_id")
    return trials.async_stop(history, 40, 3, 3, "event_id")


_GAPS = _HISTORY.replace("value AS score", "CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 7 = 0 THEN CAST('nan' AS DOUBLE) ELSE value END AS score")
_BY_VALUE = "CASE WHEN isnan(score) THEN NULL ELSE score END ASC NULLS LAST"


@query("o4_early_stop_nulls", f"""WITH {_GAPS}, {_stop_sql(40, 3, 3).replace('ORDER BY score ASC', f'ORDER BY {_BY_VALUE}')}
  SELECT trial_id, stopped_at FROM ended""")
def _(spark, sf):
    score = F.when(F.col("event_id") % 5 == 0, None).when(F.col("event_id") % 7 == 0, float("nan")).otherwise(F.col("score"))
    return trials.early_stop(_history(spark, sf).select("trial_id", "iteration", score.alias("score")), 40, 3, 3)


@query("t3_best_of_reports", f"""WITH {_HISTORY}, r AS (SELECT trial_id, iteration, max(score) FILTER (event_type = 'click') AS click,
    max(score) FILTER (event_type = 'purchase') AS purchase FROM hist GROUP BY ALL)
  SELECT trial_id, iteration, purchase FROM r WHERE purchase IS NOT NULL ORDER BY purchase, trial_id, iteration LIMIT 1""")
def _(spark, sf):
    reported = _history(spark, sf).select("trial_id", "iteration", F.col("event_type").alias("name"), F.col("score").alias("value"))
    return trials.best_trial(trials.reports(reported, ["click", "purchase"]), "purchase", ["iteration"])


@query("o4_kept_history", f"""WITH {_HISTORY}, {_stop_sql(40, 3, 3)} SELECT trial_id, iteration, score FROM hist JOIN ended USING (trial_id)
  WHERE iteration <= stopped_at""")
def _(spark, sf):
    history = _history(spark, sf).select("trial_id", "iteration", "score")
    return trials.kept_history(history, trials.early_stop(history, 40, 3, 3))


@query("t3_best_trial", f"""WITH {_TOY} SELECT trial_id, p, cumulate, {sql_rnd('score')} AS score FROM scored
  ORDER BY score, trial_id LIMIT 1""")
def _(spark, sf):
    history = trials.toy_objective(_toy_trials(spark, sf), 12, cumulate="cumulate")
    return trials.best_trial(history, "score", ["p", "cumulate"]).withColumn("score", rnd(F.col("score")))
