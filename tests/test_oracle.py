"""Every registered query with SQL against DuckDB, on the smallest tables."""

import os

import pytest

from tests.oracle_check import compare, connect
from tillcast.plans import catalog

BASE = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(BASE)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_matches_sql(spark, con, name):
    rows, problems = compare(spark, con, BASE, catalog.QUERIES[name], catalog.SQL[name])
    assert not problems, problems
    assert rows > 0


def test_every_sql_has_a_query():
    assert set(catalog.SQL) <= set(catalog.QUERIES)
