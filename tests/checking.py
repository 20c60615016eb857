"""Run a registered query and its SQL check on the same tables and compare all rows."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        connection.execute(f"create view {table} as select * from '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted_rows(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([(_plain(r[i]), type(r[i]).__name__) for i in order]) for r in rows)


def compare(frame, sql: str, connection) -> list[str]:
    """Differences between a DataFrame and a SQL result; empty when equal."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _sorted_rows(names, cursor.fetchall())
    actual = _sorted_rows(frame.columns, frame.collect())
    problems = []
    if sorted(names) != sorted(frame.columns):
        problems.append(f"columns {sorted(frame.columns)} != {sorted(names)}")
    if len(actual) != len(expected):
        problems.append(f"rows {len(actual)} != {len(expected)}")
    if not expected:
        problems.append("the check has no rows")
    if actual != expected:
        left, right = sorted(set(actual) - set(expected))[:2], sorted(set(expected) - set(actual))[:2]
        problems.append(f"only in query: {left}")
        problems.append(f"only in check: {right}")
    return problems
