"""Sketched correlations against the full matrix."""

import numpy as np
import pytest

from gridframe.operators import screening


def frame(spark, x, parts=4):
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, x array<double>").repartition(parts)


@pytest.mark.parametrize("least,size", [(0.9, 256), (0.6, 1024), (0.95, 100)])
def test_every_strong_pair_is_found(spark, least, size, monkeypatch):
    monkeypatch.setattr(screening, "_STRIP", 16)
    monkeypatch.setattr(screening, "_PAIRS", 7)
    rng = np.random.default_rng(size)
    base = rng.normal(size=(400, 20)) * 10.0 ** rng.integers(-3, 4, 20) + 100.0
    more = [s * base[:, i % 20] + a * base[:, i % 20].std() * rng.normal(size=400) for i, (s, a) in enumerate(zip(rng.choice([-1, 2], 50), rng.uniform(0, 1.5, 50)))]
    x = np.column_stack([base, *more, np.full(400, 3.0)])
    with np.errstate(invalid="ignore"):
        full = np.corrcoef(x.T)
    expected = {(i, j): full[i, j] for i in range(70) for j in range(i + 1, 70) if abs(full[i, j]) >= least}
    got = {(r["left"], r["right"]): r["corr"] for r in screening.correlated_positions(frame(spark, x), "x", "id", least, size).collect()}
    assert got.keys() == expected.keys() and len(got) > 10
    assert all(got[p] == pytest.approx(expected[p], abs=1e-9) for p in got)


def test_signs_follow_the_row_alone():
    a, b = screening.signs(np.arange(1000), 130), screening.signs(np.arange(500, 1500), 130)
    assert (a[500:] == b[:500]).all() and a.shape == (1000, 130) and set(np.unique(a)) == {-1.0, 1.0}
    assert abs(a.mean()) < 0.02 and abs((a[:, 0] * a[:, 64]).mean()) < 0.15


def test_nothing_alike_and_nothing_at_all(spark):
    rng = np.random.default_rng(3)
    assert screening.correlated_positions(frame(spark, rng.normal(size=(300, 5))), "x", "id", 0.9).count() == 0
    assert screening.correlated_positions(spark.createDataFrame([], "id long, x array<double>"), "x", "id", 0.9).count() == 0
