"""Runs a registered query and its DuckDB twin and compares them as row multisets."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> str:
    """'' if equal, else what differs."""
    cursor = con.execute(sql)
    expected_columns = [c[0] for c in cursor.description]
    expected = rows_of(expected_columns, cursor.fetchall())
    actual = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(expected_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(expected_columns)}"
    if not expected:
        return "the SQL gives no rows"
    if actual != expected:
        extra, lost = actual - expected, expected - actual
        return (
            f"{sum(actual.values())} rows, expected {sum(expected.values())}; "
            f"extra {list(extra)[:3]}, lost {list(lost)[:3]}"
        )
    return ""
