"""Every registered query against its SQL, on the given tables."""

import pytest

import __spark_entry__ as registered
from checks.catalog import ORACLES, QUERIES
from checks.compare import connect, difference

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(name, spark, sf_dir, duck):
    assert difference(QUERIES[name](spark, sf_dir).toPandas(), duck.execute(ORACLES[name]).df()) is None


def test_all_are_registered():
    assert QUERIES.items() <= registered.queries().items() and ORACLES.items() <= registered.oracle_sql().items()


def test_entry_has_rows(spark):
    assert registered.entry(spark).count() > 0
