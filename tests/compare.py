"""Spark result against SQL result as multisets of rows with columns in name order."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str, show: int = 5) -> list[str]:
    """Empty when both sides agree."""
    table = df.toArrow()
    left = rows_of(table.column_names, list(zip(*[c.to_pylist() for c in table.columns])) if table.num_rows else [])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    right = rows_of(names, result.fetchall())
    if sorted(table.column_names) != sorted(names):
        return [f"columns {sorted(table.column_names)} != {sorted(names)}"]
    if len(left) != len(right):
        return [f"{len(left)} rows != {len(right)} rows; spark {left[:2]} sql {right[:2]}"]
    return [f"{a} != {b}" for a, b in zip(left, right) if a != b][:show]
