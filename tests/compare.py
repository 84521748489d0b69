"""Compare a Spark result with a DuckDB result: names, row count and values, in any row order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in data), key=repr)


def spark_rows(df) -> list[tuple]:
    return rows(df.columns, df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return columns, rows(columns, result.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short description."""
    columns, expected = duck_rows(con, sql)
    if sorted(columns) != sorted(df.columns):
        return f"columns differ: {sorted(set(columns) ^ set(df.columns))}"
    actual = spark_rows(df)
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        return f"{len(wrong)} of {len(actual)} rows differ, columns {sorted(columns)}, first: {wrong[0][0]} expected {wrong[0][1]}"
    return None
