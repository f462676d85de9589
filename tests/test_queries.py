"""Every registered query against its SQL form."""

import os

import pytest

import __spark_entry__ as entry_module
from compare import connect, difference
from leasewise.plans.catalog import CATALOG

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(SQL))
def test_same_as_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_every_query_of_the_catalog_has_sql():
    assert set(CATALOG) <= set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["channel_id", "conversions", "first_touch", "last_touch", "multi_touch"]
