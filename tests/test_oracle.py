"""Every registered query against DuckDB on the same tables."""

import pytest

import __spark_entry__ as spark_entry
from conftest import SF_DIR
from compare import compare, open_tables
from storetally.plans.catalog import QUERIES
from storetally.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, tables, name):
    assert compare(QUERIES[name](spark, SF_DIR), tables, ORACLE[name]) == []


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 5
