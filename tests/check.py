"""Run registered queries next to their SQL and compare rows by value."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# names of equal types on the two engines
KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = Path(folder) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, value)
    if isinstance(value, float):
        return (4, "nan") if math.isnan(value) else (3, value + 0.0)
    if isinstance(value, int):
        return (2, value)
    if isinstance(value, dt.datetime):
        return (5, value.replace(tzinfo=None).isoformat())
    if isinstance(value, dt.date):
        return (6, value.isoformat())
    return (7, str(value))


def _rows(rows) -> list[tuple]:
    return sorted(tuple(map(_cell, r)) for r in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if names, types and rows agree, else a short account of what does not."""
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return f"columns {names} vs {sorted(rel.columns)}"
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    theirs = {n: KINDS.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    wrong = {n: (ours[n], theirs[n]) for n in names if ours[n] != theirs[n]}
    if wrong:
        return f"types {wrong}"
    left = _rows(df.select(*[f"`{n}`" for n in names]).collect())
    at = [rel.columns.index(n) for n in names]
    right = _rows(tuple(r[i] for i in at) for r in rel.fetchall())
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"row {a} vs {b}"
    return None
