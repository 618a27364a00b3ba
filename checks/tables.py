"""Column records derived from the given tables, and SQL fragments for the same view.

Every embedding of 64 values is read as 16 half levels x 4 variables (level = pos div 4, variable = pos mod 4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridframe.functions.arrays import reshape_row, take_variable

LEVELS = 16
VARS = 4


def registry():
    """Queries and SQL of a module, and the decorator that adds to them."""
    queries, sql_of = {}, {}

    def query(name: str, sql: str | None = None):
        def register(fn):
            queries[name] = fn
            if sql is not None:
                sql_of[name] = sql
            return fn

        return register

    return queries, sql_of, query


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("column_id"), "embedding", "label")


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Records with the matrix and its four profiles a, b, c, d."""
    m = embeddings(spark, sf).withColumn("m", reshape_row("embedding", LEVELS, VARS))
    return m.select("*", *[take_variable("m", i).alias(n) for i, n in enumerate("abcd")])


def _at(index: Column) -> Column:
    return F.col("embedding")[index % (LEVELS * VARS)]


def _over(n: int, value) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), value)


def _strided(n: int, first: int) -> Column:
    return _over(n, lambda i: _at(i * VARS + first))


def columns(spark: SparkSession, sf: str) -> DataFrame:
    """The column table: 17 scalars, 15 x 27 layer, 16 x 2 half-level, 14 x 1 interface values and the outputs."""
    profile = {f"flux_{d}_{b}": k for k, (d, b) in enumerate([("dn", "sw"), ("up", "sw"), ("dn", "lw"), ("up", "lw")])}
    return embeddings(spark, sf).select(
        F.lit("2020-01-01").cast("date").alias("date"),
        "column_id",
        _over(17, lambda i: _at(i * 4 + 3)).alias("sca_inputs"),
        _over(LEVELS - 1, lambda i: _over(27, lambda j: _at(i * 4 + j))).alias("col_inputs"),
        _over(LEVELS, lambda i: F.array(_at(i * 4), _at(i * 4 + 1))).alias("hl_inputs"),
        _over(LEVELS - 2, lambda i: F.array(_at(i * 4 + 6))).alias("inter_inputs"),
        *[_strided(LEVELS, k).alias(n) for n, k in profile.items()],
        _strided(LEVELS - 1, 0).alias("hr_sw"),
        _strided(LEVELS - 1, 2).alias("hr_lw"),
        ((F.col("column_id") % 15) * 250).cast("int").alias("timestep"),
        F.col("label").cast("int").alias("patch"),
    )


def rnd(value: Column, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    return F.round(value.cast("double"), digits) + F.lit(0.0)


def sql_rnd(value: str, digits: int = 6) -> str:
    return f"(round(CAST({value} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE))"


def big(name: str, alias: str | None = None) -> Column:
    return F.col(name).cast("bigint").alias(alias or name.split(".")[-1])


def long_vector(df: DataFrame, keys: list[str], vector: str | Column, digits: int | None = None) -> DataFrame:
    """(keys, pos, value)."""
    value = F.col("value").cast("double") if digits is None else rnd(F.col("value"), digits)
    exploded = df.select(*keys, F.posexplode(vector).alias("pos", "value"))
    return exploded.select(*[big(k) if k in ("shard", "rank") else F.col(k) for k in keys], big("pos"), value.alias("value"))


def long_matrix(df: DataFrame, keys: list[str], matrix: str | Column, digits: int | None = None) -> DataFrame:
    """(keys, level, variable, value)."""
    value = F.col("value").cast("double") if digits is None else rnd(F.col("value"), digits)
    rows = df.select(*keys, F.posexplode(matrix).alias("level", "row"))
    cells = rows.select(*keys, "level", F.posexplode("row").alias("variable", "value"))
    return cells.select(*keys, big("level"), big("variable"), value.alias("value"))


# The embeddings in long form: vec_id, label, pos, v.
PTS = """pts AS (
  SELECT vec_id AS column_id, label, CAST(i AS BIGINT) AS pos, CAST(embedding[i + 1] AS DOUBLE) AS v
  FROM (SELECT vec_id, label, embedding, unnest(range(0, len(embedding))) AS i FROM embeddings))"""

# The same with level and variable.
LVL = PTS + """, lvl AS (SELECT column_id, label, pos, pos // 4 AS level, pos % 4 AS variable, v FROM pts)"""

# Families of the column table in long form: column_id, level, variable, v.
FAM = (
    LVL
    + """, ids AS (SELECT vec_id AS column_id, (vec_id % 15) * 250 AS timestep, CAST(label AS BIGINT) AS patch,
                   embedding AS e FROM embeddings),
  sca AS (SELECT column_id, timestep, patch, i AS pos, CAST(e[(i * 4 + 3) % 64 + 1] AS DOUBLE) AS v
          FROM ids, range(17) r(i)),
  col AS (SELECT column_id, timestep, patch, i AS level, j AS variable, CAST(e[(i * 4 + j) % 64 + 1] AS DOUBLE) AS v
          FROM ids, range(15) r(i), range(27) s(j)),
  hl AS (SELECT column_id, level, variable, v FROM lvl WHERE variable < 2),
  inter AS (SELECT column_id, level - 1 AS level, CAST(0 AS BIGINT) AS variable, v FROM lvl
            WHERE variable = 2 AND level BETWEEN 1 AND 14),
  flux AS (SELECT column_id, level, variable, v FROM lvl),
  nodes_x AS (SELECT column_id, level, variable, v FROM hl
              UNION ALL SELECT i.column_id, l AS level, 2, coalesce(n.v, 0)
                FROM (SELECT column_id, l FROM ids, range(16) r(l)) i
                LEFT JOIN inter n ON n.column_id = i.column_id AND n.level + 1 = i.l
              UNION ALL SELECT column_id, l, 3 + pos, v FROM sca, range(16) r(l)),
  flat_x AS (SELECT column_id, level * 2 + variable AS pos, v FROM hl
             UNION ALL SELECT column_id, 32 + level, v FROM inter
             UNION ALL SELECT column_id, 46 + pos, v FROM sca
             UNION ALL SELECT column_id, 63 + level * 27 + variable, v FROM col),
  flat_y AS (SELECT column_id, variable * 16 + level AS pos, v FROM flux)"""
)
