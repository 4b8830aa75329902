"""Every registered query with SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

SF = "/root/testdata/sf0.001"
TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


def normal(row):
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else repr(v + 0.0) if isinstance(v, float) else str(v) for v in row)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    made = entry_points.queries()[name](spark, SF)
    columns = sorted(made.columns)
    got = sorted(normal(r) for r in made.select(*[f"`{c}`" for c in columns]).collect())
    cursor = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(normal(r[i] for i in order) for r in cursor.fetchall())
    assert got


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_key_of_sql_is_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
