"""Runs a query and its oracle and compares names, kinds and values."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def kind(value) -> str:
    for name, types in (("bool", bool), ("int", int), ("float", float), ("decimal", Decimal),
                        ("datetime", datetime), ("date", date), ("str", str)):
        if isinstance(value, types):
            return name
    return type(value).__name__


def assert_same(frame, connection, sql: str) -> int:
    columns = sorted(frame.columns)
    got = [tuple(r) for r in frame.select(*[f"`{c}`" for c in columns]).collect()]
    relation = connection.sql(sql)
    assert sorted(relation.columns) == columns
    places = [relation.columns.index(c) for c in columns]
    want = [tuple(r[p] for p in places) for r in relation.fetchall()]
    assert len(got) == len(want)
    order = lambda row: tuple((v is None, str(v) if not isinstance(v, float) else f"{v:.9f}") for v in row)
    for left, right in zip(sorted(got, key=order), sorted(want, key=order)):
        for column, a, b in zip(columns, left, right):
            assert (a is None) == (b is None), (column, left, right)
            if a is None:
                continue
            assert kind(a) == kind(b), (column, left, right)
            same = math.isclose(a, b, rel_tol=1e-12) if isinstance(a, float) else a == b
            assert same, (column, left, right)
    return len(got)
