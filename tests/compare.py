"""Spark rows against DuckDB rows, without regard to row order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        return "nan" if math.isnan(v) else f"{float(v):.9g}"
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    """What differs, or None."""
    result = con.execute(sql)
    sql_names = [c[0] for c in result.description]
    if sorted(df.columns) != sorted(sql_names):
        return f"columns {sorted(df.columns)} / {sorted(sql_names)}"
    mine, theirs = _rows(df.columns, df.collect()), _rows(sql_names, result.fetchall())
    if mine == theirs:
        return None
    a, b = set(mine), set(theirs)
    return f"rows {len(mine)} / {len(theirs)}; only spark {sorted(a - b)[:3]}; only sql {sorted(b - a)[:3]}"
