"""Spark-vs-DuckDB comparison helper used by the tests and by hand."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

from rxlake.sources.tables import TABLES

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, digits)
    if isinstance(v, Decimal):
        return round(float(v), digits)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(spark_df, con, sql: str, digits: int = 6) -> tuple[bool, str]:
    """Order-insensitive comparison on sorted column names."""
    s_cols = sorted(spark_df.columns)
    rows_s = [tuple(_norm(r[c], digits) for c in s_cols) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    if sorted(d_cols) != s_cols:
        return False, f"columns differ: spark={s_cols} duck={sorted(d_cols)}"
    idx = [d_cols.index(c) for c in s_cols]
    rows_d = [tuple(_norm(r[i], digits) for i in idx) for r in rel.fetchall()]
    if len(rows_s) != len(rows_d):
        return False, f"row counts differ: spark={len(rows_s)} duck={len(rows_d)}"
    rows_s.sort(key=_key)
    rows_d.sort(key=_key)
    for a, b in zip(rows_s, rows_d):
        if a != b:
            return False, f"first differing row:\n spark={a}\n duck ={b}"
    return True, f"{len(rows_s)} rows equal"
