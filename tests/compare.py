"""Compare a Spark result with a DuckDB result: columns by name, rows in any order."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def diff(spark_df, con, sql, limit=5):
    """Empty text when equal, else what differs."""
    cols, rows = sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.sql(sql)
    want_cols, want = sorted_rows(rel.columns, rel.fetchall())
    if cols != want_cols:
        return f"columns {cols} != {want_cols}"
    if len(rows) != len(want):
        return f"{len(rows)} rows != {len(want)}"
    bad = [(a, b) for a, b in zip(rows, want) if a != b]
    return "" if not bad else f"{len(bad)} of {len(rows)} rows differ: {bad[:limit]}"
