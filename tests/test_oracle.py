"""Every named query against its SQL on the same tables."""

from __future__ import annotations

import pytest

import compare
from __spark_entry__ import entry, oracle_sql, queries
from clickledger.queries import QUERIES
from conftest import SMALL


@pytest.fixture(scope="module")
def oracle():
    return compare.oracle_connection(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    result = queries()[name](spark, SMALL)
    sql = oracle_sql()[name]
    assert sorted(result.columns) == compare.column_names(oracle, sql)
    assert compare.spark_rows(result) == compare.oracle_rows(oracle, sql)


def test_entry_returns_attributed_checkouts(spark):
    assert entry(spark).count() == 5
