"""Comparison of a query with its SQL twin."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value.normalize()))
    if isinstance(value, dt.datetime):
        return ("time", value.isoformat())
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "TINYINT": "tinyint", "DOUBLE": "double",
    "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def difference(df, connection, sql, limit=3):
    """None when equal, else a short description."""
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    types = {c[0]: SPARK_TYPES.get(str(c[1]), str(c[1])) for c in result.description}
    unlike = {n: (t, types[n]) for n, t in df.dtypes if t != types[n]}
    if unlike:
        return f"types {unlike}"
    theirs = Counter(rows_of(names, result.fetchall()))
    mine = Counter(rows_of(df.columns, [tuple(r) for r in df.collect()]))
    if mine == theirs:
        return None
    left, right = list((mine - theirs).keys())[:limit], list((theirs - mine).keys())[:limit]
    return f"{mine.total()} rows against {theirs.total()}; {sorted(names)}\n  mine {left}\n  sql  {right}"
