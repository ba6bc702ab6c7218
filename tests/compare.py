"""Order-insensitive comparison of a Spark result with its SQL twin."""

from __future__ import annotations

import math
import os

import duckdb
from pyspark.sql import DataFrame

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return repr(value)


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    expected = _rows(names, cursor.fetchall())
    actual = _rows(df.columns, [tuple(row) for row in df.collect()])
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if actual == expected:
        return []
    left, right = set(actual) - set(expected), set(expected) - set(actual)
    return [
        f"{len(actual)} rows, expected {len(expected)}; "
        f"{len(left)} only in Spark {sorted(left)[:2]}; {len(right)} only in SQL {sorted(right)[:2]}"
    ]
