"""Every catalogued query against its DuckDB SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.check_oracle import connect, difference
from webloom.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert difference(entry.queries()[name](spark, SMALL), duck, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
