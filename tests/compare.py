"""Runs a registered query in Spark and its SQL in DuckDB and compares the whole results."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 8) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(_plain(v) for v in value.values())
    if hasattr(value, "asDict"):
        return tuple(_plain(v) for v in value)
    if isinstance(value, bool) or isinstance(value, (int, str)):
        return value
    return float(value)


def _order(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in at) for r in rows), key=lambda r: repr(_order(r)))


def compare(df, sql: str, sf: str) -> str | None:
    """None if equal, else what differs."""
    with duck(sf) as con:
        rel = con.execute(sql)
        names = [d[0] for d in rel.description]
        want = rows_of(names, rel.fetchall())
    have = rows_of(df.columns, df.collect())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(want) != len(have):
        return f"{len(have)} rows against {len(want)}"
    for a, b in zip(have, want):
        if a != b:
            return f"row {a} against {b}"
    return None
