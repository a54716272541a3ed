"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from ledgerlake.checks import oracle
from ledgerlake.checks.queries import REGISTRY
from tests.compare import database, difference

SF = "/root/testdata/sf0.001"
QUERIES = REGISTRY
SQL = oracle.statements()


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


def test_flagship(spark):
    assert entry_points.entry(spark).count() == 150


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None
