"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from throngcast.catalog.registry import QUERIES
from tests.conftest import SF_DIR
from tests.oracle_check import compare, duck

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], SQL[name], SF_DIR) == ""


def test_entry_is_not_empty(spark):
    assert entry.entry(spark).count() > 0
