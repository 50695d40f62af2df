"""Queries of the subpackage against their SQL on the smallest tables."""

import pytest
from conftest import SF
from oracle_check import compare, connect

from refiscope.llm import queries


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_its_sql(spark, con, name):
    assert compare(queries.QUERIES[name](spark, SF), con, queries.SQL[name]) is None


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
