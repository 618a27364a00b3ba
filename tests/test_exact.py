"""Exact sums against rational arithmetic, and equal bits for any partitioning."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridframe.operators import exact

FINITE = st.floats(allow_nan=False, allow_infinity=False)


def read(place, limb):
    return sum(Fraction(int(b)) * Fraction(2) ** (exact.LIMB * int(p) + exact.LOWEST) for p, b in zip(np.ravel(place), np.ravel(limb)))


@settings(max_examples=300, deadline=None)
@given(FINITE)
def test_limbs_and_squares_are_exact(value):
    values = np.array([value])
    assert read(*exact.cut_up(*np.frexp(values))) == Fraction(value)
    assert sum(read(*exact.cut_up(*part)) for part in exact.squared(values)) == Fraction(value) ** 2


@settings(max_examples=60, deadline=None)
@given(st.lists(FINITE, min_size=1, max_size=30))
def test_carries_change_no_sum(values):
    sums = exact.Sums()
    sums.add(np.zeros(len(values), dtype="int64"), np.array(values))
    before = [read(np.arange(exact.PLACES), sums.totals[0, k]) for k in (0, 1)]
    after = [read(np.arange(exact.PLACES), exact._carried(sums.totals)[0, k]) for k in (0, 1)]
    assert before == after == [sum(map(Fraction, values)), sum(Fraction(v) ** 2 for v in values)]


def test_equal_bits_for_any_partitioning(spark, monkeypatch):
    rng = random.Random(4)
    wild = lambda: rng.choice([rng.gauss(0, 1), 1e16, -1e16, 1e-300, rng.random() * 10 ** rng.randint(-140, 140)])
    rows = [(i, [wild(), rng.random(), None if i % 7 == 0 else 0.1]) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, x array<double>")
    found = []
    for parts, added in ((1, 1 << 20), (7, 100), (64, 1 << 20)):
        monkeypatch.setattr(exact, "_ROWS", added)
        out = exact.exact_moments(df.orderBy("x").repartition(parts), ["x"], unit=-1200).orderBy("pos").collect()
        found.append([(r["n"], r["sum"].hex(), r["mean"].hex(), r["std"].hex(), r["units"]) for r in out])
    assert found[0] == found[1] == found[2]
    for pos, row in enumerate(found[0]):
        values = [Fraction(x[pos]) for _, x in rows if x[pos] is not None]
        total, n = sum(values), len(values)
        variance = (sum(v * v for v in values) - total**2 / n) / n
        assert row[:4] == (n, float(total).hex(), float(total / n).hex(), math.sqrt(float(variance)).hex())
        assert int(row[4]) * Fraction(2) ** -1200 == total


def test_special_values_and_empty_input(spark):
    rows = [([1.0, math.inf, math.inf, math.nan, 1e308],), ([2.0, 1.0, -math.inf, 1.0, 1e308],), (None,), ([],)]
    out = exact.exact_moments(spark.createDataFrame(rows, "x array<double>"), ["x"], unit=1).orderBy("pos").collect()
    assert [r["n"] for r in out] == [2] * 5
    assert (out[0]["sum"], out[0]["mean"], out[0]["std"], out[0]["units"]) == (3.0, 1.5, 0.5, None)
    assert (out[1]["sum"], out[1]["mean"]) == (math.inf, math.inf) and math.isnan(out[1]["std"])
    assert math.isnan(out[2]["sum"]) and math.isnan(out[3]["mean"])
    assert (out[4]["sum"], out[4]["mean"], out[4]["std"]) == (math.inf, 1e308, 0.0)
    assert exact.exact_moments(spark.createDataFrame([], "x array<double>"), ["x"]).count() == 0
    floats = spark.createDataFrame([([[0.5], [0.25]],)], "m array<array<float>>")
    assert [r["sum"] for r in exact.exact_moments(floats, ["m"]).orderBy("pos").collect()] == [0.5, 0.25]
