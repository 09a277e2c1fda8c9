"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], SQL.get(name), SF) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 12


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
