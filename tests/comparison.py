"""Compare a Spark frame with the rows DuckDB returns for its oracle."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import DataFrame

from tests.conftest import TESTDATA


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def folder(sf: str) -> str:
    return f"{TESTDATA}/sf{sf}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def assert_same(frame: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> None:
    cursor = connection.execute(sql)
    expected = _rows([d[0] for d in cursor.description], cursor.fetchall())
    actual = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1])
    different = [(a, e) for a, e in zip(actual[1], expected[1]) if a != e]
    assert not different, different[:3]
