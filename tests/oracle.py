"""Compare a Spark result with DuckDB's, row by row and regardless of order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(frame, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    actual = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    differing = [(a, e) for a, e in zip(actual, expected) if a != e]
    if differing:
        return f"{len(differing)} of {len(actual)} rows differ over {sorted(names)}, first: {differing[0]}"
    types = [type(v) for v in actual[0]] if actual else []
    other = [type(v) for v in expected[0]] if expected else []
    if any(a is not e and type(None) not in (a, e) for a, e in zip(types, other)):
        return f"types {types} != {other}"
    return None
