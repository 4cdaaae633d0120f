"""Row-by-row comparison of a Spark result with its oracle."""

from __future__ import annotations

import datetime
import math

import duckdb

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in RAW:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value:.6f}" if abs(value) > 5e-7 else "0.000000"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()[:10]
    return f"'{value}'"


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Human-readable differences; empty if both results are the same."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected_rows = result.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        problems.append(f"columns {sorted(set(names) ^ set(df.columns))}")
        return problems
    actual, expected = normal(df.columns, df.collect()), normal(names, expected_rows)
    if len(actual) != len(expected):
        problems.append(f"rows {len(actual)} != {len(expected)}")
    if actual != expected:
        extra = [r for r in actual if r not in set(expected)][:2]
        missing = [r for r in expected if r not in set(actual)][:2]
        problems.append(f"columns {sorted(names)}\n  only spark: {extra}\n  only oracle: {missing}")
    return problems
