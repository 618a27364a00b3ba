"""Training, scoring and trial runs over the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from checks.search import _TOY, _toy_trials
from checks.tables import LVL, columns, embeddings, registry, rnd, sql_rnd, table
from gridframe.functions.arrays import node_targets
from gridframe.operators import moments, reshape, split, trials
from gridframe.plans import learn, search, stored
from gridframe.session import scratch_path

QUERIES, SQL, query = registry()


# -- one linear layer: two steps, followed exactly in SQL ------------------------------------------------------------


def _pairs(spark, sf):
    """Price predicted from the customer number, both as vectors of one value."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.array(F.col("o_custkey").cast("double")).alias("x"),
        F.array(F.col("o_totalprice") / 100000.0).alias("y"),
    )


_RATE = "CAST(0.05 AS DOUBLE)"


def _adam(n: int, name: str, rate: str = _RATE) -> str:
    """What step n takes off weight ``name``, from its gradients g1..gn (n is 1 or 2)."""
    b1, b2 = "CAST(0.9 AS DOUBLE)", "CAST(0.999 AS DOUBLE)"
    if n == 1:
        m, v, c1, c2 = f"(1 - {b1}) * {name}g1", f"(1 - {b2}) * {name}g1 * {name}g1", f"(1 - {b1})", f"(1 - {b2})"
    else:
        m = f"((1 - {b1}) * {name}g2 + {b1} * (1 - {b1}) * {name}g1)"
        v = f"((1 - {b2}) * {name}g2 * {name}g2 + {b2} * (1 - {b2}) * {name}g1 * {name}g1)"
        c1, c2 = f"(1 - {b1} * {b1})", f"(1 - {b2} * {b2})"
    return f"{rate} * ({m} / {c1}) / (sqrt({v} / {c2}) + CAST(1e-8 AS DOUBLE))"


def _two_steps(source: str, rates: str | None = None) -> str:
    """Two Adam steps of y = w x + b from zero over the rows of ``source`` (key, x, y), each on half of them; with
    ``rates`` (a relation lr) once for every rate."""
    by = "trial_id, lr, " if rates else ""
    rate = "lr" if rates else _RATE
    also = f", {rates}" if rates else ""
    group = "GROUP BY ALL" if rates else ""
    return f"""s AS (SELECT avg(x) AS m, stddev_pop(x) AS d, count(*) AS n FROM {source}),
  p AS (SELECT (x - m) / (d + CAST(1e-8 AS DOUBLE)) AS x, y, n, row_number() OVER (ORDER BY md5('42-' || key), key) - 1 AS pos FROM {source}, s),
  r AS (SELECT x, y, pos // 4 // ((n + 7) // 8) AS batch FROM p),
  a AS (SELECT {by}avg(2 * (0 - y) * x) AS wg1, avg(2 * (0 - y)) AS bg1, avg(y * y) AS l1, count(*) AS n1 FROM r{also} WHERE batch = 0 {group}),
  w1 AS (SELECT *, 0 - {_adam(1, 'w', rate)} AS w, 0 - {_adam(1, 'b', rate)} AS b FROM a),
  c AS (SELECT {by}wg1, bg1, l1, n1, w, b, avg(2 * (w * x + b - y) * x) AS wg2, avg(2 * (w * x + b - y)) AS bg2,
    avg((w * x + b - y) * (w * x + b - y)) AS l2, count(*) AS n2 FROM r, w1 WHERE batch = 1 GROUP BY ALL),
  f AS (SELECT {by}l1, n1, l2, n2, w - {_adam(2, 'w', rate)} AS w2, b - {_adam(2, 'b', rate)} AS b2 FROM c)"""


_ORDERS = "o AS (SELECT o_orderkey AS key, CAST(o_custkey AS DOUBLE) AS x, o_totalprice / 100000 AS y FROM orders)"
_LOSS = "avg((w2 * (x - m) / (d + CAST(1e-8 AS DOUBLE)) + b2 - y) * (w2 * (x - m) / (d + CAST(1e-8 AS DOUBLE)) + b2 - y))"


def _fit_line(df, **more):
    start = [np.zeros((1, 1)), np.zeros(1)]
    half = (df.count() + 7) // 8 * 4
    given = {"lr": 0.05, **more}
    return learn.fit_mlp(df, "x", "y", "o_orderkey", moments.position_moments(df, ["x"]), hidden=(), batch=half, world=4, weights=start, **given)


@query("m1_fit_mlp", f"""WITH {_ORDERS}, {_two_steps('o')}
  SELECT CAST(0 AS BIGINT) AS step, n1 AS n_rows, {sql_rnd('l1', 5)} AS loss, {sql_rnd('w2', 5)} AS slope, {sql_rnd('b2', 5)} AS shift FROM f
  UNION ALL SELECT 1, n2, {sql_rnd('l2', 5)}, {sql_rnd('w2', 5)}, {sql_rnd('b2', 5)} FROM f""")
def _(spark, sf):
    net = _fit_line(_pairs(spark, sf))
    lines = [(step, n, loss) for _, step, loss, n in net.history]
    history = spark.createDataFrame(lines, "step bigint, n_rows bigint, loss double")
    return history.select(
        "step", "n_rows", rnd(F.col("loss"), 5).alias("loss"),
        rnd(F.lit(float(net.weights[0][0, 0])), 5).alias("slope"), rnd(F.lit(float(net.weights[1][0])), 5).alias("shift"),
    )


@query("m1_fit_with_validation", f"""WITH {_ORDERS}, {_two_steps('o')}
  SELECT CAST(0 AS BIGINT) AS epoch, 'train_loss' AS name, {sql_rnd('(l1 * n1 + l2 * n2) / (n1 + n2)', 5)} AS value FROM f
  UNION ALL SELECT 0, 'val_loss', {sql_rnd(_LOSS, 5)} FROM o, s, f WHERE key % 10 = 0
  UNION ALL SELECT 0, 'test_loss', {sql_rnd(_LOSS, 5)} FROM o, s, f WHERE key % 10 = 1""")
def _(spark, sf):
    df = _pairs(spark, sf)
    held = {"val": df.where("o_orderkey % 10 = 0"), "test": df.where("o_orderkey % 10 = 1")}
    reports = spark.createDataFrame(_fit_line(df, validation=held).reports, "epoch bigint, name string, value double")
    return reports.withColumn("value", rnd(F.col("value"), 5))


_HIDDEN = [np.array([[0.6, -0.4]]), np.array([0.1, 0.2]), np.array([[0.5], [-0.8]]), np.array([0.3])]


def _unit(k: int) -> str:
    """Value and slope of hidden unit k."""
    z = f"(CAST({_HIDDEN[0][0, k]} AS DOUBLE) * x + CAST({_HIDDEN[1][k]} AS DOUBLE))"
    gate = f"(1 / (1 + exp(0 - {z})))"
    return f"{z} * {gate} AS h{k}, {gate} + {z} * {gate} * (1 - {gate}) AS d{k}"


_SLOPES = {
    "w00": ("avg(e * CAST(0.5 AS DOUBLE) * d0 * x)", 0.6), "w01": ("avg(e * CAST(-0.8 AS DOUBLE) * d1 * x)", -0.4),
    "b00": ("avg(e * CAST(0.5 AS DOUBLE) * d0)", 0.1), "b01": ("avg(e * CAST(-0.8 AS DOUBLE) * d1)", 0.2),
    "w10": ("avg(e * h0)", 0.5), "w11": ("avg(e * h1)", -0.8), "b10": ("avg(e)", 0.3),
}


@query("m1_fit_mlp_hidden", f"""WITH {_ORDERS}, s AS (SELECT avg(x) AS m, stddev_pop(x) AS d FROM o),
  p AS (SELECT (x - m) / (d + CAST(1e-8 AS DOUBLE)) AS x, y FROM o, s),
  u AS (SELECT x, y, {_unit(0)}, {_unit(1)} FROM p),
  g AS (SELECT *, 2 * (h0 * CAST(0.5 AS DOUBLE) - h1 * CAST(0.8 AS DOUBLE) + CAST(0.3 AS DOUBLE) - y) AS e FROM u),
  t AS (SELECT avg(e * e / 4) AS loss, {', '.join(f'{v} AS {k}' for k, (v, _) in _SLOPES.items())} FROM g)
  SELECT 'loss' AS name, {sql_rnd('loss', 5)} AS value FROM t UNION ALL
  {' UNION ALL '.join(f"SELECT '{k}', {sql_rnd(f'{w} - {_RATE} * {k} / (abs({k}) + CAST(1e-8 AS DOUBLE))', 5)} FROM t" for k, (_, w) in _SLOPES.items())}""")
def _(spark, sf):
    """Two hidden units, one step over all orders."""
    df = _pairs(spark, sf)
    stats = moments.position_moments(df, ["x"])
    net = learn.fit_mlp(df, "x", "y", "o_orderkey", stats, hidden=(2,), batch=(df.count() + 3) // 4 * 4, lr=0.05, world=4, weights=_HIDDEN)
    values = np.concatenate([[net.history[0][2]], *[w.ravel() for w in net.weights]]).tolist()
    rows = spark.createDataFrame(list(zip(["loss", *_SLOPES], values)), "name string, value double")
    return rows.withColumn("value", rnd(F.col("value"), 5))


# -- scoring with given weights --------------------------------------------------------------------------------------

# Two units over quantity and discount, one output.
_NET = [np.array([[0.8, -0.3], [0.5, 0.9]]), np.array([0.1, -0.2]), np.array([[1.5], [-0.7]]), np.array([0.05])]


def _measures(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array(F.col("l_quantity") / 50.0, F.col("l_discount") * 10.0).alias("x"),
        F.array(F.col("l_extendedprice") / 100000.0).alias("y"),
    )


_SCORED = """z AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice / 100000 AS y, l_quantity / 50 AS q, l_discount * 10 AS d FROM lineitem),
  h AS (SELECT *, q * CAST(0.8 AS DOUBLE) + d * CAST(0.5 AS DOUBLE) + CAST(0.1 AS DOUBLE) AS h0,
    q * CAST(-0.3 AS DOUBLE) + d * CAST(0.9 AS DOUBLE) - CAST(0.2 AS DOUBLE) AS h1 FROM z),
  o AS (SELECT l_orderkey, l_linenumber, y, CAST(1.5 AS DOUBLE) * h0 / (1 + exp(-h0)) - CAST(0.7 AS DOUBLE) * h1 / (1 + exp(-h1)) + CAST(0.05 AS DOUBLE) AS y_hat FROM h)"""


@query("m2_predict", f"WITH {_SCORED} SELECT l_orderkey, l_linenumber, {sql_rnd('y_hat')} AS y_hat FROM o")
def _(spark, sf):
    scored = learn.predict(_measures(spark, sf), learn.Network(_NET), "x")
    return scored.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), rnd(F.col("y_hat")[0]).alias("y_hat"))


@query("m2_predict_stored", SQL["m2_predict"])
def _(spark, sf):
    """The network is written and read again; scoring is given nothing but its path."""
    path = scratch_path(spark, "network")
    stored.save_network(spark, learn.Network(_NET), path)
    scored = stored.predict_stored(_measures(spark, sf), path, "x")
    return scored.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), rnd(F.col("y_hat")[0]).alias("y_hat"))


@query("m3_evaluate", f"WITH {_SCORED} SELECT 'test' AS stage, count(*) AS n, {sql_rnd('avg((y_hat - y) * (y_hat - y))')} AS mse FROM o")
def _(spark, sf):
    out = learn.evaluate(_measures(spark, sf), learn.Network(_NET), "x", "y", "test")
    return out.withColumn("mse", rnd(F.col("mse")))


@query("m3_fit_and_evaluate", f"""WITH {_ORDERS}, ranked AS (SELECT *, row_number() OVER (ORDER BY md5('42-' || key), key) - 1 AS place, count(*) OVER () AS total FROM o),
  parts AS (SELECT key, x, y, CASE WHEN place < total * 8 // 10 THEN 'train' WHEN place < total * 8 // 10 + total // 10 THEN 'val' ELSE 'test' END AS stage FROM ranked),
  fitted AS (SELECT key, x, y FROM parts WHERE stage = 'train'), {_two_steps('fitted')}
  SELECT stage, count(*) AS n, {sql_rnd(_LOSS, 5)} AS mse FROM parts, s, f GROUP BY stage""")
def _(spark, sf):
    parts = split.random_split(_pairs(spark, sf), "o_orderkey", 42)
    net = _fit_line(parts.where(F.col("split") == "train").drop("split"))
    stages = [learn.evaluate(parts.where(F.col("split") == s), net, "x", "y", s) for s in ("train", "val", "test")]
    return stages[0].unionByName(stages[1]).unionByName(stages[2]).withColumn("mse", rnd(F.col("mse"), 5))


# -- flux heads ------------------------------------------------------------------------------------------------------


def _flux_records(spark, sf):
    """Both bands as levels x 2 vectors, heating rates as given, and a pressure that grows with the level."""
    records = columns(spark, sf)
    pressure = F.transform("hl_inputs", lambda row, i: (i * 60.0 + 20.0 + F.abs(row[1])).cast("double"))
    flat = reshape.flattened(records, ["column_id"]).select("column_id", "x")
    rest = records.select(
        "column_id",
        F.flatten(node_targets("flux_dn_sw", "flux_up_sw")).alias("sw"),
        F.flatten(node_targets("flux_dn_lw", "flux_up_lw")).alias("lw"),
        "hr_sw", "hr_lw", pressure.alias("pressure"),
    )
    return flat.join(rest, "column_id")


_TARGETS = {k: k for k in ("sw", "lw", "hr_sw", "hr_lw", "pressure")}


def _measured(df, net, x):
    """Losses and absolute errors of a network with flux heads, one row each."""
    losses, absolute = learn.evaluate_flux_heads(df, net, x, _TARGETS)
    lines = F.inline(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("value")) for c in losses.columns]))
    return losses.select(lines).unionByName(absolute.select(F.concat(F.lit("mae_"), "output").alias("measure"), F.col("mae").alias("value")))


_BANDS = [(band, name) for band, name in enumerate(("sw", "lw"))]


def _errors_sql(o: str, tag: str = "") -> str:
    """Gaps of fluxes and heating rates of the outputs ``o`` (column_id, band, level, ch, v)."""
    return f"""n{tag} AS (SELECT column_id, band, level, max(v) FILTER (ch = 0) - max(v) FILTER (ch = 1) AS net FROM {o} GROUP BY ALL),
  s{tag} AS (SELECT column_id, band, level, lead(net) OVER w - net AS dn, CAST(-9.80665 AS DOUBLE) / 1004 * 86400 / (lead(p) OVER w - p) AS factor
    FROM n{tag} JOIN p USING (column_id, level) WINDOW w AS (PARTITION BY column_id, band ORDER BY level)),
  h{tag} AS (SELECT s.column_id, s.band, s.level, factor, factor * dn - l.v AS gap
    FROM s{tag} s JOIN lvl l ON l.column_id = s.column_id AND l.level = s.level AND l.variable = s.band * 2 WHERE s.level < 15),
  f{tag} AS (SELECT column_id, band, level, ch, o.v - t.v AS gap FROM {o} o JOIN t USING (column_id, band, level, ch))"""


def _measures_sql(tag: str = "") -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{name}' AS k, avg(gap * gap) AS q, avg(abs(gap)) AS a FROM f{tag} WHERE band = {band}"
        f" UNION ALL SELECT 'hr_{name}', avg(gap * gap), avg(abs(gap)) FROM h{tag} WHERE band = {band}"
        for band, name in _BANDS
    )
    return f"""m{tag} AS ({parts})
  SELECT 'mse_' || k AS measure, {sql_rnd('q', 4)} AS value FROM m{tag} UNION ALL SELECT 'mae_' || k, {sql_rnd('a', 4)} FROM m{tag}
  UNION ALL SELECT 'loss', {sql_rnd('sum(q)', 4)} FROM m{tag}"""


_W = "((i * 7 + k * 3) % 11 - 5) / CAST(10 AS DOUBLE)"
_PLACE = "k // 32 AS band, k % 32 // 2 AS level, k % 2 AS ch"
_FLUX = f"""{LVL}, x AS (SELECT column_id, pos AS i, v FROM pts),
  o AS (SELECT column_id, k, {_PLACE}, sum(v * {_W}) + max(k) / CAST(64 AS DOUBLE) AS v FROM x, range(64) r(k) GROUP BY ALL),
  t AS (SELECT column_id, variable // 2 AS band, level, variable % 2 AS ch, v FROM lvl),
  p AS (SELECT column_id, level, level * 60 + 20 + abs(v) AS p FROM lvl WHERE variable = 1),
  {_errors_sql('o')}"""
_START = [np.array([[((i * 7 + k * 3) % 11 - 5) / 10.0 for k in range(64)] for i in range(64)]), np.arange(64) / 64.0]


def _whole_records(spark, sf):
    """The flux records with all 64 values as input."""
    return _flux_records(spark, sf).drop("x").join(embeddings(spark, sf).select("column_id", F.col("embedding").alias("x")), "column_id")


@query("m4_score_flux_heads", f"WITH {_FLUX}, {_measures_sql()}")
def _(spark, sf):
    net = learn.Network(_START, levels=16)
    return _measured(_whole_records(spark, sf), net, "x").withColumn("value", rnd(F.col("value"), 4))


# One Adam step from the start: each weight moves by the rate against the sign of its slope.
_STEP = "CAST(0.001 AS DOUBLE) * g / (abs(g) + CAST(1e-8 AS DOUBLE))"
_HEADS_STEP = f"""{_FLUX},
  b AS (SELECT column_id, band, level, coalesce(c, 0) - coalesce(lag(c) OVER w, 0) AS back FROM
    (SELECT n.column_id, n.band, n.level, -2 * h.gap * h.factor / CAST(15 AS DOUBLE) AS c FROM n LEFT JOIN h USING (column_id, band, level))
    WINDOW w AS (PARTITION BY column_id, band ORDER BY level)),
  e AS (SELECT column_id, f.band * 32 + f.level * 2 + f.ch AS k, f.gap / CAST(16 AS DOUBLE) + (1 - 2 * f.ch) * b.back AS slope
    FROM f JOIN b USING (column_id, band, level)),
  w2 AS (SELECT i, k, {_W} - {_STEP} AS w FROM (SELECT i, k, avg(x.v * slope) AS g FROM x JOIN e USING (column_id) GROUP BY ALL)),
  b2 AS (SELECT k, k / CAST(64 AS DOUBLE) - {_STEP} AS w FROM (SELECT k, avg(slope) AS g FROM e GROUP BY k)),
  l AS (SELECT (SELECT sum(gap * gap) / 32 FROM f) + (SELECT sum(gap * gap) / 15 FROM h) AS total, count(*) AS rows FROM embeddings)"""


def _one_step(spark, sf):
    df = _whole_records(spark, sf)
    batch = (df.count() + 3) // 4 * 4
    net = learn.fit_flux_heads(df, "x", _TARGETS, "column_id", 16, dropout=0.0, l1=0.0, l2=0.0, lr=1e-3, batch=batch, world=4, weights=_START)
    return df, net


@query("m4_fit_flux_heads", f"""WITH {_HEADS_STEP}
  SELECT k, {sql_rnd('any_value(b2.w)', 5)} AS bias, {sql_rnd('sum(w2.w)', 5)} AS weights, {sql_rnd('any_value(total / rows)', 3)} AS loss
  FROM w2 JOIN b2 USING (k), l GROUP BY k""")
def _(spark, sf):
    """New weights of every output after one step over all records, and the loss before it."""
    _, net = _one_step(spark, sf)
    rows = [(k, float(net.weights[1][k]), float(net.weights[0][:, k].sum()), float(net.history[0][2])) for k in range(64)]
    out = spark.createDataFrame(rows, "k bigint, bias double, weights double, loss double")
    return out.select("k", rnd(F.col("bias"), 5).alias("bias"), rnd(F.col("weights"), 5).alias("weights"), rnd(F.col("loss"), 3).alias("loss"))


@query("m4_evaluate_flux_heads", f"""WITH {_HEADS_STEP},
  o2 AS (SELECT column_id, k, {_PLACE}, sum(v * w2.w) + max(b2.w) AS v FROM x JOIN w2 USING (i) JOIN b2 USING (k) GROUP BY ALL),
  {_errors_sql('o2', '2')}, {_measures_sql('2')}""")
def _(spark, sf):
    df, net = _one_step(spark, sf)
    return _measured(df, net, "x").withColumn("value", rnd(F.col("value"), 4))


# -- trials ----------------------------------------------------------------------------------------------------------


def reciprocal(cumulate: bool, p: int, iterations: int):
    """Score 1 / p with p growing by one, cumulated on request."""
    total = 0.0
    for i in range(iterations):
        score = 1.0 / (p + i)
        total += score
        yield {"score": total if cumulate else score}


@query("o2_run_trials", f"WITH {_TOY} SELECT trial_id, CAST(iteration AS BIGINT) AS iteration, 'score' AS name, {sql_rnd('score')} AS value FROM scored")
def _(spark, sf):
    history = search.run_trials(_toy_trials(spark, sf), reciprocal, ["cumulate", "p"], {"iterations": 12})
    return history.withColumn("value", rnd(F.col("value")))


@query("o2_train_trials", f"""WITH {_ORDERS}, rates AS (SELECT i AS trial_id, CAST([0.01, 0.05, 0.2][i + 1] AS DOUBLE) AS lr FROM range(3) r(i)),
  {_two_steps('o', 'rates')}
  SELECT trial_id, CAST(1 AS BIGINT) AS iteration, 'train_loss' AS name, {sql_rnd('l1', 5)} AS value FROM f
  UNION ALL SELECT trial_id, 2, 'train_loss', {sql_rnd('l2', 5)} FROM f""")
def _(spark, sf):
    """A grid of learning rates, each fitted to the same stored batches."""
    df = _pairs(spark, sf)
    half = (df.count() + 7) // 8 * 4
    grid = trials.sample_space(spark.range(1).withColumnRenamed("id", "trial_id"), {"lr": trials.grid_search([0.01, 0.05, 0.2])}, seed=1)
    drawn = grid.select(F.col("grid_id").cast("bigint").alias("trial_id"), "lr")
    kept = learn.store_batches(df, "o_orderkey", half, 42, 4)

    def fit(params):
        net = _fit_line(df, lr=params["lr"], stored=kept)
        return [(step + 1, "train_loss", loss) for _, step, loss, _ in net.history]

    history = search.train_trials(drawn, fit, at_once=2)
    kept.remove(spark)
    return history.withColumn("value", rnd(F.col("value"), 5))


_RATES = [0.001, 0.2, 0.01, 0.5, 0.05, 1.0, 0.02, 0.1, 0.005]
_VAL = "avg((w * x + b - y) * (w * x + b - y)) FILTER (key % 10 = 0) AS val"


@query("o4_live_stop", f"""WITH {_ORDERS}, s AS (SELECT avg(x) AS m, stddev_pop(x) AS d FROM o),
  r AS (SELECT key, (x - m) / (d + CAST(1e-8 AS DOUBLE)) AS x, y FROM o, s),
  rates AS (SELECT CAST(i AS BIGINT) AS trial_id, CAST({_RATES}[i + 1] AS DOUBLE) AS lr FROM range({len(_RATES)}) r(i)),
  a AS (SELECT trial_id, lr, avg(2 * (0 - y) * x) AS wg1, avg(2 * (0 - y)) AS bg1 FROM r, rates GROUP BY ALL),
  w1 AS (SELECT *, 0 - {_adam(1, 'w', 'lr')} AS w, 0 - {_adam(1, 'b', 'lr')} AS b FROM a),
  c AS (SELECT trial_id, lr, wg1, bg1, w, b, avg(2 * (w * x + b - y) * x) AS wg2, avg(2 * (w * x + b - y)) AS bg2, {_VAL} FROM r, w1 GROUP BY ALL),
  k AS (SELECT *, row_number() OVER (ORDER BY val, trial_id) AS place FROM c),
  w2 AS (SELECT trial_id, w - {_adam(2, 'w', 'lr')} AS w, b - {_adam(2, 'b', 'lr')} AS b FROM k WHERE place <= 3),
  e AS (SELECT trial_id, {_VAL} FROM r, w2 GROUP BY trial_id)
  SELECT trial_id, CAST(1 AS BIGINT) AS iteration, 'val_loss' AS name, {sql_rnd('val', 4)} AS value FROM c
  UNION ALL SELECT trial_id, 2, 'val_loss', {sql_rnd('val', 4)} FROM e""")
def _(spark, sf):
    """Nine learning rates, one step an epoch; after the first epoch the best three go on."""
    df = _pairs(spark, sf)
    whole = (df.count() + 3) // 4 * 4
    stats = moments.position_moments(df, ["x"])
    held = {"val": df.where("o_orderkey % 10 = 0")}
    drawn = spark.createDataFrame(list(enumerate(_RATES)), "trial_id bigint, lr double")
    kept = learn.store_batches(df, "o_orderkey", whole, 42, 4)
    start = [np.zeros((1, 1)), np.zeros(1)]

    def advance(params, state, done, until):
        net = learn.fit_mlp(
            df, "x", "y", "o_orderkey", stats, hidden=(), epochs=until - done, batch=whole, lr=params["lr"], world=4, weights=start,
            stored=kept, validation=held, resume=state,
        )
        return net, [(e + 1, name, v) for e, name, v in net.reports if e >= done and name == "val_loss"]

    history = search.train_until_stopped(drawn, advance, scratch_path(spark, "reports"), 2, 1, 3, "val_loss")
    kept.remove(spark)
    return history.withColumn("value", rnd(F.col("value"), 4))
