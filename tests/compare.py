"""Comparison of Spark results with DuckDB over the same Parquet tables."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb

FLOAT_DIGITS = 9


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.{FLOAT_DIGITS}g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def row_set(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is not None, str(v)) for v in row))


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), row_set(df.columns, df.collect())


def duck_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), row_set(columns, cursor.fetchall())
