"""Registered corpus queries against their SQL, on the given tables."""

import pytest

from checks.compare import connect, difference
from tickbars.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, sf_dir):
    assert difference(QUERIES[name](spark, sf_dir).toPandas(), connect(sf_dir).execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_query_has_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0
