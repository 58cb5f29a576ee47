"""Strict comparison of a registered query with its oracle SQL."""

from __future__ import annotations

import glob
import math
import os
from datetime import date, datetime

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, date) and not isinstance(v, datetime):
        return datetime(v.year, v.month, v.day)
    return v


def _key(row):
    return tuple((v is not None, str(type(v)), str(round(v, 9)) if isinstance(v, float) else str(v)) for v in row)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return type(a) is type(b) and a == b


def difference(spark_df, con, sql: str) -> str | None:
    """None when both sides hold the same columns, types and rows; else what differs first."""
    ours = spark_df.collect()
    rel = con.execute(sql)
    theirs_cols = [d[0] for d in rel.description]
    theirs = rel.fetchall()
    if sorted(spark_df.columns) != sorted(theirs_cols):
        return f"columns {sorted(spark_df.columns)} != {sorted(theirs_cols)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)} rows"
    names = sorted(theirs_cols)
    for x, y in zip(rows_of(spark_df.columns, ours), rows_of(theirs_cols, theirs)):
        for name, a, b in zip(names, x, y):
            if not same(a, b):
                return f"{name}: {a!r} != {b!r} in {x} / {y}"
    return None
