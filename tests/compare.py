"""Compare a Spark result with DuckDB SQL over the same tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return value


def duck_rows(connection, sql: str):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    return sorted(names), rows


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, Counter(tuple(_plain(value) for value in row) for row in frame.select(*names).collect())


def differences(frame, connection, sql: str) -> str:
    """Empty when both sides have the same columns and the same rows, bit for bit."""
    left_names, left = spark_rows(frame)
    right_names, right = duck_rows(connection, sql)
    if left_names != right_names:
        return f"columns {left_names} against {right_names}"
    only_left, only_right = left - right, right - left
    if only_left or only_right:
        return (
            f"{sum(left.values())} against {sum(right.values())} rows, {sum(only_left.values())} only in Spark "
            f"{list(only_left)[:3]}, {sum(only_right.values())} only in SQL {list(only_right)[:3]}"
        )
    return ""
