"""Runs a query and its SQL side by side and tells where they differ."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(folder, f"{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    """Tells 1 from 1.0 and 0.0 from -0.0, as a hash of the values would."""
    return type(value).__name__, repr(value)


def _bag(columns: list[str], rows: list[tuple]) -> Counter:
    places = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in places) for row in rows)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """``None`` if both give the same rows, else a short account of the difference."""
    result = con.execute(sql)
    names = [item[0] for item in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected = _bag(names, result.fetchall())
    actual = _bag(df.columns, [tuple(row) for row in df.collect()])
    if actual == expected:
        return None
    missing, extra = expected - actual, actual - expected
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"{sum(missing.values())} missing, e.g. {list(missing)[:2]}; "
        f"{sum(extra.values())} extra, e.g. {list(extra)[:2]}"
    )
