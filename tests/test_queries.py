"""Every registered query against its DuckDB twin."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as driver
from grantweave import oracles
from grantweave import queries as registry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float | decimal.Decimal):
        return f"{float(value):.6f}"
    return str(value)


def _rows(table):
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return names, sorted(tuple(map(_cell, row)) for row in zip(*columns))


def test_every_query_has_a_twin():
    assert set(registry.ALL) == set(oracles.all_sql())
    assert set(registry.ALL) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(registry.ALL))
def test_query(spark, duck, name):
    ours = driver.queries()[name](spark, SF).toArrow()
    theirs = duck.sql(driver.oracle_sql()[name]).to_arrow_table()
    assert _rows(ours) == _rows(theirs)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
