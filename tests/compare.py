"""Row-for-row comparison of a Spark result with DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return connection


def _sort_key(row):
    return tuple((value is None, str(value)) for value in row)


def compare(spark_df, connection, sql: str) -> list[str]:
    """Differences in columns, row count and values; exact, NULL equals NULL."""
    names = sorted(spark_df.columns)
    relation = connection.sql(sql)
    if names != sorted(relation.columns):
        return [f"columns {names} != {sorted(relation.columns)}"]
    found = sorted((tuple(row) for row in spark_df.select(*names).collect()), key=_sort_key)
    expected = sorted(relation.select(*[f'"{name}"' for name in names]).fetchall(), key=_sort_key)
    if len(found) != len(expected):
        return [f"{len(found)} rows != {len(expected)}"]
    problems = []
    for left, right in zip(found, expected):
        for name, a, b in zip(names, left, right):
            if a != b and not (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b)):
                problems.append(f"{name}: {a!r} != {b!r}")
            elif type(a) is not type(b):
                problems.append(f"{name}: type {type(a)} != {type(b)}")
    return problems[:10]
