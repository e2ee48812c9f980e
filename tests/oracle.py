"""Compare a registered query with its SQL, both over the same parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        files = path / "*.parquet" if path.is_dir() else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, int):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day).isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, folder) -> str:
    """"" when columns, rows and values agree exactly, otherwise what differs."""
    df = fn(spark, folder)
    got_columns, got = df.columns, [tuple(r) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
        return "the plan forms pairs of rows without a key"
    result = con.execute(sql)
    want_columns, want = [d[0] for d in result.description], result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    a, b = _sorted_rows(got_columns, got), _sorted_rows(want_columns, want)
    for x, y in zip(a, b):
        if x != y:
            return f"values differ: {x} != {y}"
    return "" if got else "no rows"
