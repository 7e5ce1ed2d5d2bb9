"""Every catalog query against DuckDB on the smallest data folder."""

import pytest

import __spark_entry__ as entry
from checks import oracle
from checks.compare import connect, difference
from ledgermill import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    found = difference(QUERIES[name](spark, FOLDER), duck, SQL[name])
    assert found is None, found


def test_entry(spark):
    assert entry.entry(spark).count() > 0
