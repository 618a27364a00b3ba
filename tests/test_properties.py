"""Properties that hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridframe.functions import arrays
from gridframe.operators import index, moments, normalize

quick = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
numbers = st.floats(-1e6, 1e6, allow_nan=False, width=32)


def matrices(min_rows=1):
    return st.tuples(st.integers(min_rows, 6), st.integers(1, 5)).flatmap(
        lambda s: st.lists(st.lists(numbers, min_size=s[1], max_size=s[1]), min_size=s[0], max_size=s[0])
    )


@quick
@given(matrices(), st.integers(0, 3), st.integers(0, 3))
def test_padding_adds_rows_of_zeros(spark, m, top, bottom):
    padded = spark.createDataFrame([(m,)], "m array<array<float>>").select(arrays.pad_levels("m", top, bottom)).first()[0]
    zeros = [0.0] * len(m[0])
    assert padded == [zeros] * top + m + [zeros] * bottom


@quick
@given(matrices())
def test_reshape_undoes_flatten(spark, m):
    df = spark.createDataFrame([(m,)], "m array<array<float>>")
    back = df.select(arrays.reshape_row(arrays.flatten_row("m"), len(m), len(m[0]))).first()[0]
    assert back == m


@quick
@given(st.integers(0, 10**15), st.integers(1, 10**7))
def test_locating_can_be_undone(spark, position, size):
    shard, row = index.locate(F.lit(position), size)
    found = spark.range(1).select(shard.alias("s"), row.alias("r")).first()
    assert found["s"] * size + found["r"] == position and 0 <= found["r"] < size


@quick
@given(st.integers(1, 100_000), st.integers(1, 5_000))
def test_shard_counts_divide(spark, n, target):
    row = index.plan_shards(spark.createDataFrame([(n,)], "n_rows bigint"), target).first()
    assert row["num_shards"] * row["shard_size"] == n
    best = min((d for d in range(1, n + 1) if n % d == 0), key=lambda d: (abs(d - target), d))
    assert row["num_shards"] == best


@quick
@given(st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=1, max_size=60), st.integers(1, 20))
def test_histogram_counts_everything(spark, values, bins):
    import numpy as np

    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = moments.histogram(df, "v", bins).orderBy("bin").collect()
    assert len(rows) == bins and sum(r["count"] for r in rows) == len(values)
    if max(values) - min(values) > 1e-6 or max(values) == min(values):
        width = rows[0]["high"] - rows[0]["low"]
        assert abs(sum(r["density"] for r in rows) * width - 1) < 1e-9
        assert [r["count"] for r in rows] == list(np.histogram(values, bins)[0])


@quick
@given(st.lists(st.lists(numbers, min_size=3, max_size=3), min_size=2, max_size=30))
def test_normalised_values_have_mean_0_and_std_1(spark, rows):
    df = spark.createDataFrame([(r,) for r in rows], "x array<double>")
    scaled = normalize.normalize(df, "x", moments.position_moments(df, ["x"]))
    before = {r["pos"]: r for r in moments.position_moments(df, ["x"]).collect()}
    for r in moments.position_moments(scaled, ["x"]).collect():
        assert abs(r["mean"]) < 1e-5
        if before[r["pos"]]["std"] > 1e-2:
            assert abs(r["std"] - 1) < 1e-5
