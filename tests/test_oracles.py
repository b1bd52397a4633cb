"""Every query next to its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as registry
import check_oracles

PATH = "/root/testdata/sf0.001"
QUERIES, TEXTS = registry.queries(), registry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(PATH), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in check_oracles.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{PATH}/{table}.parquet'")
    return connection


def test_every_text_has_a_query():
    assert set(TEXTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(TEXTS)))
def test_query_equals_sql(spark, db, name):
    ours = check_oracles.normalized(QUERIES[name](spark, PATH).toPandas())
    theirs = check_oracles.normalized(db.execute(TEXTS[name]).fetchdf())
    assert list(ours.columns) == list(theirs.columns)
    assert ours.equals(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(TEXTS)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, PATH).count() > 0


def test_entry(spark):
    assert registry.entry(spark).count() > 0
