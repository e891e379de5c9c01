"""Every registered query against its SQL on the small tables."""

import pytest
from compare import difference, duck
from conftest import SF

import __spark_entry__ as entry

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 202


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SF), connection.sql(SQL[name])) is None
