"""Every registered query against independent SQL on the same tables.

The queries of the optional subpackage have tests of their own.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from compare import connect, from_duckdb, from_spark
from meterlake.plans import oracles, registry

QUERIES = registry.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = connect(sf_dir)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert entry_points.queries().keys() >= QUERIES.keys()
    assert entry_points.oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, duck, name):
    columns, rows = from_spark(QUERIES[name](spark, sf_dir))
    expected_columns, expected_rows = from_duckdb(duck, ORACLES[name])
    assert columns == expected_columns
    assert rows == expected_rows
    assert rows


def test_entry(spark, sf_dir):
    frame = entry_points.entry(spark)
    assert frame.columns[0] == "hour_of_day"
    assert frame.count() > 0
