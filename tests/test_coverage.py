"""The test data must be able to fail a query: no compared column is empty, every case occurs."""

import os

import pytest

from compare import connect
from leasewise.plans.catalog import CATALOG
from leasewise.plans.oracle import oracle

SF_DIR = os.environ.get("TEST_COVERAGE_DIR", "/root/testdata/sf0.01")
# Columns that a query gives the same value by its meaning.
BY_MEANING = {
    "first_basket": {"dense_rank"}, "second_basket": {"dense_rank"}, "fulfilment_lines": {"quantity"}, "subscriptions": {"quantity"},
    # Only churned members have an end, so none lapses under another label.
    "kpis_daily": {f"lapsed_{s}{t}_members{c}" for s in ("new", "scheduled", "active") for t in ("", "_annual", "_monthly", "_per_item") for c in ("", "_cum")},
    "unwrap_cells": {"gone"}, "aliases": {"absent"}, "projected": {"o_clerk"}, "drift": {"row_count"}, "variant_drift": {"row_count", "type"},
}
# Columns the tables cannot fill: a basket of one flagship alone; three regions with the same usual duration (`duration_by_sku` has others).
NOT_REACHED = {
    "channel_daily": {"first_order_flagship_only"},
    "duration_median": {"min_duration", "median_duration"}, "kpis_daily": {"current_inactive_per_item_members"},
}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(CATALOG))
def test_no_compared_column_is_empty_or_constant(con, name):
    q = CATALOG[name]
    counts = ", ".join(f'count("{c}"), count(DISTINCT "{c}")' for c, _ in q.columns)
    n, *found = con.execute(f"SELECT count(*), {counts} FROM ({q.oracle()})").fetchone()
    assert n > 0
    flat = {c for i, (c, _) in enumerate(q.columns) if n > 1 and (found[2 * i] == 0 or (found[2 * i] == n and found[2 * i + 1] == 1))}
    assert flat <= BY_MEANING.get(name, set()) | NOT_REACHED.get(name, set())


def test_every_lifecycle_case_and_type_occurs(con):
    cases = {r[0] for r in con.execute(oracle("SELECT DISTINCT status_case FROM o_members")).fetchall()}
    assert set(range(1, 13)) <= cases
    types = {r[0] for r in con.execute(oracle("SELECT DISTINCT membership_type FROM o_members")).fetchall()}
    assert types == {"annual", "monthly", "per-item", "influencer", "gift-card-buyer", "registry-product-buyer", "lead"}
    assert con.execute(oracle("SELECT count(*) FROM o_memberships WHERE status = 'inactive'")).fetchone()[0] > 5
    channels = {r[0] for r in con.execute(oracle("SELECT DISTINCT channel_id FROM o_attributed")).fetchall()}
    assert len(channels) > 3
