"""Queries that SQL can express, against another engine on the small tables."""

import glob
import math
import os

import duckdb
import pytest

from boxoffice.llm import queries
from conftest import SF


def close(left, right):
    if isinstance(left, float) and isinstance(right, float):
        return math.isclose(left, right, rel_tol=1e-9, abs_tol=1e-9)
    return left == right


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_equals_its_sql(spark, name):
    other = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        other.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = other.execute(queries.statements()[name])
    columns = [column[0] for column in result.description]
    df = queries.registered()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    mine, theirs = (sorted(map(tuple, rows), key=str) for rows in (df.select(*columns).collect(), result.fetchall()))
    assert len(mine) == len(theirs)
    assert all(close(a, b) for one, two in zip(mine, theirs) for a, b in zip(one, two))
