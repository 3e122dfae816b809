"""Every catalogue query against its DuckDB SQL, on whole tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.queries import QUERIES
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    _, difference = compare(queries()[name](spark, SMALL), con, SQL[name])
    assert difference == ""


def test_entry(spark):
    assert entry(spark).count() > 0
