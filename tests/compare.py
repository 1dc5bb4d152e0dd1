"""Run a registered query and its SQL on the same folder and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def row_bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark_df, sql: str, connection) -> tuple[list[str], int, int, list]:
    """Schema differences, row counts and some rows only one side has."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = row_bag(names, result.fetchall())
    ours = row_bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    schema = sorted(set(names) ^ set(spark_df.columns))
    only = list((ours - theirs).items())[:3] + list((theirs - ours).items())[:3]
    return schema, sum(ours.values()), sum(theirs.values()), only
