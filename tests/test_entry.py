"""Every registered query against its SQL, on the smallest tables."""

import os
from collections import Counter

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = "orders lineitem events documents pages"

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return connection


def test_every_query_has_sql():
    assert set(entry.own_queries()) == set(entry.own_oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.own_queries()))
def test_same_rows_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = Counter(tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == theirs


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "chunk_id", "inserted"] and df.count() > 0
