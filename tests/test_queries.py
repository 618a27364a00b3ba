"""Every registered query against its SQL counterpart, and against forbidden plan nodes."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical, plan
    if name in SQL:
        assert differences(df, con, SQL[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["pos", "mean", "std"]
    rows = df.collect()
    assert len(rows) == 64
    assert all(abs(r["mean"]) < 1e-6 and abs(r["std"] - 1) < 1e-6 for r in rows)
