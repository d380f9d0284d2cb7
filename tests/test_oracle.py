"""Every query with an SQL twin gives the same rows as DuckDB, and the rest run."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference, spark_table, sql_table

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equal_to_sql(spark, con, name):
    mine = spark_table(entry.queries()[name](spark, FOLDER))
    assert difference(mine, sql_table(con, entry.oracle_sql()[name])) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
