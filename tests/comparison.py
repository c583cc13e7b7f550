"""Compare a Spark result with the result of its SQL in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str):
    database = duckdb.connect()
    database.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return database


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(frame, sql: str | None, database) -> str | None:
    """None when equal, otherwise a short description."""
    ours = _rows(frame.columns, frame.collect())
    if sql is None:
        return f"rows only: {len(ours)}"
    result = database.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns differ: {sorted(frame.columns)} / {sorted(columns)}"
    theirs = _rows(columns, result.fetchall())
    if not theirs and not ours:
        return None
    if len(ours) != len(theirs):
        return f"row counts differ: {len(ours)} / {len(theirs)}"
    names = sorted(columns)
    for a, b in zip(ours, theirs):
        if [type(x) for x in a] != [type(x) for x in b] or a != b:
            wrong = [(n, x, y) for n, x, y in zip(names, a, b) if x != y or type(x) is not type(y)]
            return f"values differ: {wrong[:4]}"
    return None
