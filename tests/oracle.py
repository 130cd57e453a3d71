"""Comparing a query with its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def differences(frame, connection, sql: str) -> str | None:
    """None if rows and column names agree, else what differs."""
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    order = sorted(names)
    got = Counter(tuple(_plain(row[n]) for n in order) for row in frame.collect())
    positions = [names.index(n) for n in order]
    want = Counter(tuple(_plain(row[i]) for i in positions) for row in expected)
    if got == want:
        return None
    extra, lacking = list((got - want).items())[:3], list((want - got).items())[:3]
    return f"{sum(got.values())} rows against {sum(want.values())}; only here {extra}; only there {lacking}"


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return 0.0 if value == 0 else float(f"{value:.12g}")
    return value
