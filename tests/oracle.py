"""Runs a registered query and its SQL over the same tables and compares all values."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    """One form per value, whichever engine it came from."""
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(df, sql: str, con: duckdb.DuckDBPyConnection) -> int:
    expected = con.sql(sql)
    assert sorted(df.columns) == sorted(expected.columns)
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    theirs = normal(expected.columns, expected.fetchall())
    assert len(ours) == len(theirs), f"{len(ours)} rows, expected {len(theirs)}"
    for mine, other in zip(ours, theirs):
        assert mine == other, f"{mine} != {other}"
    types = dict(zip(expected.columns, (str(t) for t in expected.types)))
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
    }
    for name, kind in df.dtypes:
        assert kinds.get(kind, kind) == types[name], f"{name}: {kind} vs {types[name]}"
    return len(ours)
