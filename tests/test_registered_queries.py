"""Every registered query equals its SQL over whole tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_equals_sql(spark, connection, name):
    found = entry.queries()[name](spark, SF)
    assert difference(found, connection, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
