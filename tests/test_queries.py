"""Every registered query against its SQL in another engine, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from boxoffice import oracle, queries
from conftest import SF

QUERIES = queries.registered()
SQL = oracle.statements()


@pytest.fixture(scope="module")
def other():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, other, name):
    df = QUERIES[name](spark, SF)
    result = other.execute(SQL[name])
    columns = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert ordered(map(tuple, df.select(*columns).collect())) == ordered(result.fetchall())


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1
