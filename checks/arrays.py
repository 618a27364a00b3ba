"""Array reshaping, reports, physics and normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.tables import (
    FAM, LEVELS, LVL, PTS, VARS, big, columns, embeddings, long_matrix, long_vector, profiles, registry, rnd, sql_rnd, table,
)
from gridframe.functions import arrays, physics
from gridframe.operators import exact, moments, normalize, reshape, screening
from gridframe.operators.index import with_shard
from gridframe.schema import FAMILIES, FEATURES, LAST_TIMESTEP, variables
from gridframe.session import scratch_path
from gridframe.sources import catalog
from gridframe.sources.columns import every_nth, pick_variable, union_parts

QUERIES, SQL, query = registry()

ID = ["column_id"]


@query("p1_select_features", f"""WITH {FAM} SELECT column_id, pos, v AS value FROM sca
  UNION ALL SELECT column_id, 17 + level * 27 + variable, v FROM col
  UNION ALL SELECT column_id, 422 + level * 2 + variable, v FROM hl
  UNION ALL SELECT column_id, 454 + level, v FROM inter
  UNION ALL SELECT column_id, 468 + variable * 16 + level, v FROM flux""")
def _(spark, sf):
    picked = reshape.select_features(columns(spark, sf), FEATURES)
    return long_vector(picked, ID, F.concat(*[reshape.as_vector(picked, c) for c in FEATURES]))


@query("p2_flatten_row", f"WITH {PTS} SELECT column_id, pos, v AS value FROM pts")
def _(spark, sf):
    return long_vector(profiles(spark, sf), ID, arrays.flatten_row("m"))


@query("p3_concat_features", f"WITH {FAM} SELECT 'x' AS part, * FROM (SELECT column_id, pos, v AS value FROM flat_x) "
       "UNION ALL SELECT 'y', column_id, pos, v FROM flat_y")
def _(spark, sf):
    flat = reshape.flattened(columns(spark, sf))
    parts = [long_vector(flat, ID, p).withColumn("part", F.lit(p)) for p in ("x", "y")]
    return parts[0].unionByName(parts[1])


@query("p4_add_axis", f"WITH {LVL} SELECT column_id, level, CAST(0 AS BIGINT) AS variable, v AS value FROM lvl WHERE variable = 0")
def _(spark, sf):
    return long_matrix(profiles(spark, sf), ID, arrays.add_axis("a"))


@query("p5_broadcast_to_levels", f"WITH {FAM} SELECT column_id, l AS level, pos AS variable, v AS value FROM sca, range(16) r(l)")
def _(spark, sf):
    return long_matrix(columns(spark, sf), ID, arrays.broadcast_to_levels("sca_inputs", LEVELS))


@query("p6_pad_levels", f"WITH {FAM} SELECT column_id, level, variable, v AS value FROM nodes_x WHERE variable = 2")
def _(spark, sf):
    padded = long_matrix(columns(spark, sf), ID, arrays.pad_levels("inter_inputs"))
    return padded.withColumn("variable", F.lit(2).cast("bigint"))


@query("p7_node_features", f"WITH {FAM} SELECT column_id, level, variable, v AS value FROM nodes_x")
def _(spark, sf):
    return long_matrix(columns(spark, sf), ID, arrays.node_features("hl_inputs", "inter_inputs", "sca_inputs"))


@query("p8_node_targets", f"WITH {FAM} SELECT column_id, level, variable, v AS value FROM flux")
def _(spark, sf):
    return long_matrix(columns(spark, sf), ID, arrays.node_targets("flux_dn_sw", "flux_up_sw", "flux_dn_lw", "flux_up_lw"))


@query("p9_edge_features", f"WITH {FAM} SELECT column_id, level, variable, v AS value FROM col")
def _(spark, sf):
    return long_matrix(reshape.features(columns(spark, sf)), ID, "edge")


@query("p10_take_variable", f"WITH {LVL} SELECT column_id, level AS pos, v AS value FROM lvl WHERE variable = 2")
def _(spark, sf):
    return long_vector(profiles(spark, sf), ID, arrays.take_variable("m", 2))


@query("p11_squeeze", f"WITH {LVL} SELECT column_id, level AS pos, v AS value FROM lvl WHERE variable = 1")
def _(spark, sf):
    return long_vector(reshape.flux_axis(profiles(spark, sf), "b"), ID, arrays.squeeze("b"))


@query("p12_reshape_row", f"WITH {LVL} SELECT column_id, level, variable, v AS value FROM lvl")
def _(spark, sf):
    return long_matrix(embeddings(spark, sf), ID, arrays.reshape_row("embedding", LEVELS, VARS))


@query("p13_cast_to", f"WITH {PTS} SELECT typeof(CAST([1] AS DOUBLE[])) AS kind, pos, {sql_rnd('sum(v)')} AS total FROM pts GROUP BY pos")
def _(spark, sf):
    cast = embeddings(spark, sf).select("column_id", arrays.cast_to("embedding", "double").alias("v"))
    kind = {"array<double>": "DOUBLE[]"}[cast.schema["v"].dataType.simpleString()]
    summed = cast.select(F.posexplode("v").alias("pos", "v")).groupBy("pos").agg(rnd(F.sum("v")).alias("total"))
    return summed.select(F.lit(kind).alias("kind"), big("pos"), "total")


@query("p14_shape_report", """SELECT * FROM (VALUES ('x', 16, 20), ('y', 16, 4), ('edge', 15, 27)) t("array", axis_1, axis_2),
  (SELECT count(*) AS n_rows FROM embeddings WHERE len(embedding) = 64)""")
def _(spark, sf):
    report = reshape.shape_report(reshape.features(columns(spark, sf)), ["x", "y", "edge"])
    return report.select("array", "axis_1", "axis_2", "n_rows")


@query("p15_size_report", """SELECT count(*) AS n_rows, CAST(sum(len(embedding) * 4) AS BIGINT) AS n_bytes,
  count(DISTINCT vec_id % 15 * 250) AS n_instants FROM embeddings""")
def _(spark, sf):
    instants = embeddings(spark, sf).withColumn("timestep", F.col("column_id") % 15 * 250)
    return reshape.size_report(instants, ["embedding"], "timestep")


@query("p16_layout_report", """SELECT o_orderkey // 500 AS shard, count(*) AS n_rows, min(o_orderkey) AS first_id,
  max(o_orderkey) AS last_id FROM orders GROUP BY 1""")
def _(spark, sf):
    report = reshape.layout_report(with_shard(table(spark, sf, "orders"), "o_orderkey", 500), "o_orderkey")
    return report.withColumn("shard", big("shard"))


def _names_sql(family: str) -> str:
    return f"(VALUES {', '.join(f'({i}, {n!r})' for i, n in enumerate(variables(family)))}) n(i, name)"


@query("s3_variables", f"""WITH {FAM}
  SELECT name, column_id, CAST(0 AS BIGINT) AS pos, v AS value FROM sca JOIN {_names_sql('sca_inputs')} ON pos = i
  UNION ALL SELECT name, column_id, level, v FROM col JOIN {_names_sql('col_inputs')} ON variable = i
  UNION ALL SELECT name, column_id, level, v FROM hl JOIN {_names_sql('hl_inputs')} ON variable = i
  UNION ALL SELECT name, column_id, level, v FROM inter JOIN {_names_sql('inter_inputs')} ON variable = i""")
def _(spark, sf):
    records, parts = columns(spark, sf), []
    names = [n for family in FAMILIES for n in variables(family)]
    for name in names:
        records = pick_variable(records, name)
        flat = records.schema[name].dataType.typeName() != "array"
        parts.append(F.struct(F.lit(name).alias("name"), (F.array(name) if flat else F.col(name)).alias("v")))
    named = records.select("column_id", F.inline(F.array(*parts)))
    return long_vector(named, ["name", "column_id"], "v")


@query("s2_every_nth", f"WITH {FAM} SELECT column_id, timestep, patch FROM ids WHERE timestep IN (0, 500, 1000, 1500, 2000, 2500, 3000, 3500)")
def _(spark, sf):
    return every_nth(columns(spark, sf), 500, high=LAST_TIMESTEP).select("column_id", big("timestep"), big("patch"))


@query("s2_every_nth_open", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey >= 100 AND (o_orderkey - 100) % 250 = 0")
def _(spark, sf):
    return every_nth(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 250, 100, column="o_orderkey")


# -- moments ---------------------------------------------------------------------------------------------------------

_MOMENTS = f"{sql_rnd('avg(v)')} AS mean, {sql_rnd('stddev_pop(v)')} AS std"


def _rounded(df, *keys):
    return df.select(*keys, *[rnd(F.col(c)).alias(c) for c in ("mean", "std") if c in df.columns])


_SOURCES = {"sca_inputs": ("sca", "pos"), "col_inputs": ("col", "variable"), "hl_inputs": ("hl", "variable"), "inter_inputs": ("inter", "variable")}


@query("a1_variable_moments", f"WITH {FAM} " + " UNION ALL ".join(
    f"SELECT name, count(*) AS n, {_MOMENTS} FROM {t} JOIN {_names_sql(family)} ON {key} = i GROUP BY name" for family, (t, key) in _SOURCES.items()))
def _(spark, sf):
    records = columns(spark, sf)
    found = [moments.variable_moments(records, family, variables(family)) for family in FAMILIES]
    return _rounded(union_parts(found), "name", "n")


@query("a2_profile_moments", f"WITH {LVL} SELECT variable, level, {_MOMENTS} FROM lvl GROUP BY ALL")
def _(spark, sf):
    return _rounded(moments.profile_moments(profiles(spark, sf), "m"), big("variable"), big("level"))


_FEATURE_STATS = f"""WITH {FAM}, vals AS (
    SELECT 'x' AS "array", level * 20 + variable AS pos, v FROM nodes_x
    UNION ALL SELECT 'y', level * 4 + variable, v FROM flux
    UNION ALL SELECT 'edge', level * 27 + variable, v FROM col)
  SELECT "array", pos, count(*) AS n, {_MOMENTS} FROM vals GROUP BY ALL"""


@query("a4_position_moments", _FEATURE_STATS)
def _(spark, sf):
    stats = moments.position_moments(reshape.features(columns(spark, sf)), ["x", "y", "edge"])
    return _rounded(stats, "array", big("pos"), "n")


@query("a4_exact_sums", " UNION ALL ".join(f"""SELECT CAST({i} AS BIGINT) AS pos, count(*) AS n,
  CAST(sum(CAST({c} * CAST(1152921504606846976 AS DOUBLE) AS HUGEINT)) AS VARCHAR) AS units FROM lineitem""" for i, c in enumerate(["l_extendedprice", "l_discount * l_quantity"])))
def _(spark, sf):
    """Sums of measures to the last bit, in units of 2 ** -60: nothing is rounded on either side."""
    lines = table(spark, sf, "lineitem").select(F.array("l_extendedprice", F.col("l_discount") * F.col("l_quantity")).alias("v"))
    return exact.exact_moments(lines, ["v"], unit=-60).select(big("pos"), "n", "units")


@query("a4_merged_moments", _FEATURE_STATS)
def _(spark, sf):
    """States by timestep and patch, the later timesteps added to the earlier ones, merged from what is stored."""
    path = scratch_path(spark, "states")
    records = reshape.features(columns(spark, sf))
    keys = columns(spark, sf).select("column_id", "timestep", "patch")
    for part in ("timestep < 1500", "timestep >= 1500"):
        states = moments.position_states(records.join(keys.where(part), "column_id"), ["x", "y", "edge"], ["timestep", "patch"])
        catalog.save_states(states, path)
    return _rounded(moments.merge_states(catalog.load_states(spark, path)), "array", big("pos"), "n")


@query("a4_position_moments_flattened", f"""WITH {FAM}, vals AS (
    SELECT 'x' AS "array", pos, v FROM flat_x UNION ALL SELECT 'y', pos, v FROM flat_y)
  SELECT "array", pos, count(*) AS n, {_MOMENTS} FROM vals GROUP BY ALL""")
def _(spark, sf):
    stats = moments.position_moments(reshape.flattened(columns(spark, sf)), ["x", "y"])
    return _rounded(stats, "array", big("pos"), "n")


@query("a4_position_moments_summarizer", f"WITH {PTS} SELECT 'embedding' AS \"array\", pos, count(*) AS n, {_MOMENTS} FROM pts GROUP BY pos")
def _(spark, sf):
    stats = moments.position_moments(embeddings(spark, sf), ["embedding"], route="summarizer")
    return _rounded(stats, "array", big("pos"), "n")


@query("a5_position_mean", f"WITH {PTS} SELECT 'embedding' AS \"array\", pos, {sql_rnd('avg(v)')} AS mean FROM pts GROUP BY pos")
def _(spark, sf):
    return _rounded(moments.position_mean(embeddings(spark, sf), ["embedding"]), "array", big("pos"))


def _histogram_sql(values: str, bins: int) -> str:
    return f"""WITH vals AS ({values}),
  ends AS (SELECT min(v) AS lo, max(v) AS hi FROM vals),
  span AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM ends),
  counts AS (SELECT least(CAST(floor((v - lo) * {bins} / (hi - lo)) AS BIGINT), {bins - 1}) AS bin, count(*) AS n
             FROM vals, span WHERE v IS NOT NULL GROUP BY 1),
  total AS (SELECT sum(n) AS t FROM counts)
  SELECT b AS bin, {sql_rnd(f'lo + b * ((hi - lo) / {bins})', 4)} AS low, {sql_rnd(f'lo + (b + 1) * ((hi - lo) / {bins})', 4)} AS high,
    CAST(coalesce(n, 0) AS BIGINT) AS count, {sql_rnd(f'coalesce(n, 0) / (t * ((hi - lo) / {bins}))', 9)} AS density
  FROM range({bins}) r(b) LEFT JOIN counts ON counts.bin = r.b, span, total"""


def _binned(hist):
    return hist.select(big("bin"), rnd(F.col("low"), 4).alias("low"), rnd(F.col("high"), 4).alias("high"), "count",
                       rnd(F.col("density"), 9).alias("density"))


@query("a6_histogram", _histogram_sql("SELECT l_extendedprice AS v FROM lineitem", 150))
def _(spark, sf):
    return _binned(moments.histogram(table(spark, sf, "lineitem"), "l_extendedprice"))


@query("a6_array_histogram", _histogram_sql(
    "SELECT CAST(v AS DOUBLE) AS v FROM (SELECT unnest(embedding) AS v FROM embeddings)", 150))
def _(spark, sf):
    return _binned(moments.array_histogram(profiles(spark, sf), "m"))


@query("a7_stats_table", f"""WITH {PTS}, s AS (SELECT pos, avg(v) AS m, stddev_pop(v) AS d FROM pts GROUP BY pos)
  SELECT 'embedding_mean' AS name, pos, {sql_rnd('m')} AS value FROM s
  UNION ALL SELECT 'embedding_std', pos, {sql_rnd('d')} FROM s""")
def _(spark, sf):
    named = moments.stats_table(moments.position_moments(embeddings(spark, sf), ["embedding"]))
    return named.select("name", big("pos"), rnd(F.col("value")).alias("value"))


@query("a8_row_count", "SELECT count(*) AS dataset_len FROM lineitem")
def _(spark, sf):
    return moments.row_count(table(spark, sf, "lineitem"))


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a13_screen_spread", " UNION ALL ".join(
    f"SELECT '{m}' AS name, {sql_rnd(f'stddev_pop({m})', 5)} AS std, stddev_pop({m}) < 0.1 AS useless FROM lineitem" for m in _MEASURES))
def _(spark, sf):
    spread, _ = moments.screen_variables(table(spark, sf, "lineitem"), _MEASURES, 0.1, 0.9)
    return spread.withColumn("std", rnd(F.col("std"), 5))


@query("a13_screen_pairs", " UNION ALL ".join(
    f"""SELECT '{a}' AS "left", '{b}' AS "right", {sql_rnd(f'corr({a}, {b})')} AS corr, abs(corr({a}, {b})) >= 0.9 AS redundant FROM lineitem"""
    for i, a in enumerate(_MEASURES) for b in _MEASURES[i + 1:]))
def _(spark, sf):
    _, pairs = moments.screen_variables(table(spark, sf, "lineitem"), _MEASURES, 0.1, 0.9)
    return pairs.withColumn("corr", rnd(F.col("corr")))


_ALIKE = """z AS (SELECT vec_id, list_concat(e, [e[i + 1] + CAST(0.25 AS DOUBLE) * e[(i * 7 + 3) % 64 + 1] FOR i IN range(24)]) AS e FROM
  (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
  q AS (SELECT vec_id, unnest(range(88)) AS pos, unnest(e) AS v FROM z),
  c AS (SELECT a.pos AS "left", b.pos AS "right", corr(a.v, b.v) AS corr FROM q a JOIN q b ON a.vec_id = b.vec_id AND a.pos < b.pos GROUP BY ALL)"""


@query("a13_sketched_pairs", f"""WITH {_ALIKE} SELECT "left", "right", {sql_rnd('corr', 5)} AS corr FROM c WHERE abs(corr) >= 0.9""")
def _(spark, sf):
    """The embeddings' positions and 24 more that are mostly copies of one of them."""
    own = F.transform("embedding", lambda v: v.cast("double"))
    blend = lambda i: F.get("e", i) + F.lit(0.25) * F.get("e", (i * 7 + 3) % 64)
    wide = embeddings(spark, sf).select("column_id", own.alias("e"))
    wide = wide.select("column_id", F.concat("e", F.transform(F.sequence(F.lit(0), F.lit(23)), blend)).alias("v"))
    return screening.correlated_positions(wide, "v", "column_id", 0.9).withColumn("corr", rnd(F.col("corr"), 5))


@query("a13_position_pairs", f"""WITH {PTS} SELECT a.pos AS "left", b.pos AS "right", {sql_rnd('corr(a.v, b.v)')} AS corr, abs(corr(a.v, b.v)) >= 0.1 AS redundant
  FROM pts a JOIN pts b ON a.column_id = b.column_id AND a.pos < b.pos GROUP BY a.pos, b.pos""")
def _(spark, sf):
    pairs = moments.screen_positions(table(spark, sf, "embeddings"), "embedding", 0.1)
    return pairs.withColumn("corr", rnd(F.col("corr")))


# -- normalisation and physics ---------------------------------------------------------------------------------------

_STATS = PTS + ", s AS (SELECT pos, avg(v) AS m, stddev_pop(v) AS d FROM pts GROUP BY pos)"


@query("j2_attach_stats", f"""WITH {_STATS} SELECT column_id, pos, v AS value, {sql_rnd('m')} AS mean, {sql_rnd('d')} AS std
  FROM pts JOIN s USING (pos)""")
def _(spark, sf):
    df = embeddings(spark, sf)
    stats = normalize.attach_stats(df, moments.position_moments(df, ["embedding"]), ["embedding"])
    zipped = F.arrays_zip("embedding", "embedding_mean", "embedding_std")
    long = stats.select("column_id", F.posexplode(zipped).alias("pos", "z"))
    return long.select("column_id", big("pos"), F.col("z.embedding").cast("double").alias("value"),
                       rnd(F.col("z.embedding_mean")).alias("mean"), rnd(F.col("z.embedding_std")).alias("std"))


@query("f1_normalize", f"WITH {_STATS} SELECT column_id, pos, {sql_rnd('(v - m) / (d + 1e-8)')} AS value FROM pts JOIN s USING (pos)")
def _(spark, sf):
    df = embeddings(spark, sf)
    scaled = normalize.normalize(df, "embedding", moments.position_moments(df, ["embedding"]))
    return long_vector(scaled, ID, "embedding", 6)


@query("f1_normalize_matrix", f"""WITH {_STATS} SELECT column_id, pos // 4 AS level, pos % 4 AS variable,
  {sql_rnd('(v - m) / (d + 1e-8)')} AS value FROM pts JOIN s USING (pos)""")
def _(spark, sf):
    df = profiles(spark, sf)
    return long_matrix(normalize.normalize(df, "m", moments.position_moments(df, ["m"])), ID, "m", 6)


@query("f1_normalized_moments", f"""WITH {_STATS}, z AS (SELECT pos, (v - m) / (d + 1e-8) AS z FROM pts JOIN s USING (pos))
  SELECT pos, {sql_rnd('avg(z)')} AS mean, {sql_rnd('stddev_pop(z)')} AS std FROM z GROUP BY pos""")
def normalized_moments(spark, sf):
    df = embeddings(spark, sf)
    scaled = normalize.normalize(df, "embedding", moments.position_moments(df, ["embedding"]))
    return _rounded(moments.position_moments(scaled, ["embedding"]), big("pos"))


@query("f2_heating_rate", f"""WITH {LVL}, p AS (
    SELECT column_id, level, max(v) FILTER (variable = 0) - max(v) FILTER (variable = 1) AS net, max(v) FILTER (variable = 2) AS pr
    FROM lvl GROUP BY ALL),
  d AS (SELECT column_id, level, lead(net) OVER w - net AS dn, lead(pr) OVER w - pr AS dp FROM p
        WINDOW w AS (PARTITION BY column_id ORDER BY level))
  SELECT column_id, level AS pos, {sql_rnd('CAST(-9.80665 AS DOUBLE) / 1004 * 86400 * (dn / nullif(dp, 0))', 3)} AS value
  FROM d WHERE level < 15""")
def _(spark, sf):
    return long_vector(profiles(spark, sf), ID, physics.heating_rate("a", "b", "c"), 3)


@query("f3_silu", f"WITH {PTS} SELECT column_id, pos, {sql_rnd('v / (1 + exp(-v))')} AS value FROM pts")
def _(spark, sf):
    cells = embeddings(spark, sf).select("column_id", F.posexplode("embedding").alias("pos", "v"))
    return cells.select("column_id", big("pos"), rnd(physics.silu(F.col("v").cast("double"))).alias("value"))


@query("f4_net_flux", f"""WITH {LVL} SELECT column_id, level AS pos,
  {sql_rnd('max(v) FILTER (variable = 0) - max(v) FILTER (variable = 1)')} AS value FROM lvl GROUP BY ALL""")
def _(spark, sf):
    records = profiles(spark, sf)
    return long_vector(records, ID, physics.net_flux(arrays.cast_to("a", "double"), arrays.cast_to("b", "double")), 6)


@query("w1_level_diff", f"""WITH {LVL}, d AS (SELECT column_id, level,
    lead(v) OVER (PARTITION BY column_id ORDER BY level) - v AS value FROM lvl WHERE variable = 0)
  SELECT column_id, level AS pos, {sql_rnd('value')} AS value FROM d WHERE level < 15""")
def _(spark, sf):
    return long_vector(profiles(spark, sf), ID, arrays.level_diff(arrays.cast_to("a", "double")), 6)
