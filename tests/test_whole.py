"""The wide models are compared whole: what they produce is what their query compares."""

import os

import pytest

from leasewise.plans.bindings import TestWarehouse
from leasewise.plans.catalog import CATALOG

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ["address_key", "type_profile", "item_dim", "member_dim", "member_agg", "kpis_daily"])
def test_all_columns_are_compared(spark, name):
    q = CATALOG[name]
    assert sorted(q.build(TestWarehouse(spark, SF_DIR)).columns) == sorted(c for c, _ in q.columns)
