"""Every registered query equals its SQL twin."""

import pytest

import __spark_entry__ as entry
import compare
import oracle
from conftest import SMALL
from snapline.plans import queries as plans

SQL = oracle.oracle_sql()
QUERIES = plans.queries()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


def test_every_query_has_a_twin():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare.difference(QUERIES[name](spark, SMALL), con, SQL[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
