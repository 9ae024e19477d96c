"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value if value is None else str(value)


def canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shaped, key=lambda r: tuple((v is None, v or "") for v in r))


def from_spark(frame) -> tuple[list[str], list[tuple]]:
    return canonical(frame.columns, [tuple(r) for r in frame.collect()])


def from_duckdb(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    return canonical([d[0] for d in result.description], result.fetchall())
