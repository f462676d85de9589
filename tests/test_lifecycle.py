"""One row per status case, three-valued logic, type rules, intervals."""

from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from leasewise.functions import calendar
from leasewise.operators import kpis, lifecycle, rentals

AS_OF = date(2022, 6, 1)
NEW, OLD = datetime(2022, 5, 20), datetime(2020, 1, 1)
COLS = ("who string, membership_type string, first_membership_purchase_ts timestamp, last_membership_payment_ts timestamp, last_product_payment_ts timestamp, "
        "ct_items_with_scheduled_delivery int, ct_items_with_scheduled_pickup int, ct_active_products int, ct_skus_delivered int, is_only_flagship_rented int, first_delivery_date date")
CASES = [
    ("monthly", OLD, NEW, None, 0, 0, 0, 0, 0, None, 1), ("annual", OLD, NEW, None, 2, 0, 0, 0, 0, None, 2),
    ("monthly", OLD, NEW, None, 0, 0, 2, 2, 0, date(2022, 1, 1), 3), ("monthly", OLD, NEW, None, 2, 1, 2, 2, 0, date(2022, 1, 1), 4),
    ("per-item", None, None, None, 1, 0, 1, 1, 0, date(2022, 1, 1), 5), ("monthly", OLD, NEW, None, 0, 0, 1, 1, 0, date(2022, 5, 1), 6),
    ("monthly", OLD, NEW, None, 1, 0, 0, 3, 0, date(2022, 1, 1), 7), ("monthly", OLD, NEW, None, 0, 2, 2, 2, 0, date(2022, 1, 1), 8),
    ("monthly", OLD, OLD, OLD, 0, 0, 2, 2, 0, date(2021, 1, 1), 9), ("annual", OLD, NEW, None, 0, 0, 0, 2, 0, date(2021, 1, 1), 10),
    ("monthly", OLD, OLD, OLD, 0, 0, 0, 2, 0, date(2021, 1, 1), 11), ("monthly", OLD, NEW, None, 0, 0, 1, 1, 1, date(2022, 1, 1), 12),
    # Stale membership but fresh product payments still count as current.
    ("monthly", OLD, OLD, NEW, 0, 0, 2, 2, 0, date(2021, 1, 1), 3),
    # Never paid: neither current nor lapsed.
    ("monthly", OLD, None, None, 0, 0, 0, 2, 0, date(2021, 1, 1), None), (None, None, None, None, None, None, None, None, None, None, None),
]


def test_status_cases(spark):
    data = [(str(i), *c[:-1]) for i, c in enumerate(CASES)]
    out = lifecycle.member_status(spark.createDataFrame(data, COLS), AS_OF)
    got = {int(w): (c, s) for w, c, s in rows(out, "who", "status_case", "member_status")}
    for i, c in enumerate(CASES):
        want = c[-1]
        assert got[i] == (want, lifecycle.STATUS_LABELS[want][0] if want else None), i


def test_end_of_churned(spark):
    df = spark.createDataFrame([("annual", "Churned", OLD, date(2021, 1, 1)), ("monthly", "Churned", OLD, None), ("per-item", "Churned", OLD, date(2021, 1, 1)), ("annual", "Active", OLD, None)],
                               "membership_type string, member_status string, last_membership_payment_ts timestamp, last_pickup_dt date")
    got = [r[0] for r in df.select(lifecycle.membership_end()).collect()]
    assert got == [OLD.date() + timedelta(days=370), OLD.date() + timedelta(days=35), date(2021, 1, 1), None]


def test_refunded_payment_leaves_the_earlier(spark):
    ledger = spark.createDataFrame([
        ("o1", "l1", 1, datetime(2022, 1, 1), 18.0, "order", "s", "m", "Monthly Membership"), ("o2", "l2", 1, datetime(2022, 2, 1), 18.0, "order", "s", "m", "Monthly Membership"),
        ("o2", "l2", -1, datetime(2022, 2, 9), -18.0, "return", "s", "m", "Monthly Membership")],
        "order_id string, line_item_id string, quantity int, transaction_ts timestamp, net_sales double, sales_type string, sku string, member_id string, product_name string")
    row = lifecycle.payment_agg(ledger, AS_OF).collect()[0]
    assert row.max_month_payment_ts == datetime(2022, 1, 1)


INTERVALS = [("open", date(2022, 1, 30), None), ("short", date(2022, 1, 30), date(2022, 2, 1)), ("empty", date(2022, 2, 1), date(2022, 2, 1)),
             ("late", date(2022, 3, 1), None), ("none", None, None), ("early", date(2021, 12, 1), date(2022, 1, 3))]


def brute_days(first, last):
    out = []
    for name, s, e in INTERVALS:
        d = first
        while d <= last:
            if s and s <= d and (e is None or d < e):
                out.append((name, d))
            d += timedelta(days=1)
    return out


def test_interval_forms_agree(spark):
    first, last = date(2022, 1, 1), date(2022, 2, 3)
    df = spark.createDataFrame(INTERVALS, "name string, s date, e date")
    want = brute_days(first, last)
    assert rows(calendar.expand_days(df, "s", "e", last, first), "name", "date") == sorted(want, key=str)
    closed = {n: d for n, d in rows(df.select("name", calendar.overlap_days("s", "e", first, last).alias("n")))}
    assert closed == {n: sum(w[0] == n for w in want) for n, _, _ in INTERVALS}
    totals = calendar.running_total(df.withColumn("v", F.lit(2)), "s", "e", "v", first, last)
    per_day = {d: float(v) for d, v in rows(totals)}
    assert len(per_day) == 34 and all(v == 2.0 * sum(w[1] == d for w in want) for d, v in per_day.items())


def test_months_touch_both_ends(spark):
    df = spark.createDataFrame([("a", date(2022, 1, 31), date(2022, 3, 1)), ("b", date(2022, 2, 1), date(2022, 1, 31)), ("c", date(2021, 5, 5), None)], "n string, s date, e date")
    got = rows(calendar.expand_months(df, "s", "e", "2022-01-01", "2022-04-15"), "n", "month")
    assert [m.month for n, m in got if n == "a"] == [1, 2, 3] and [n for n, _ in got].count("c") == 4 and not [1 for n, _ in got if n == "b"]


def test_depreciation_totals(spark):
    items = spark.createDataFrame([("b1", 720.0), ("b2", 1.0)], "bin string, actual_purchase_price double")
    out = spark.createDataFrame([("b1", date(2022, 1, 1)), ("b1", date(2022, 2, 1)), ("b2", None)], "bin string, delivery_date date")
    got = rows(rentals.daily_depreciation(items, out, "2022-01-01", "2022-01-03"), "date", "depreciated_amount")
    assert [float(v) for _, v in got] == [1.0, 2.0, 3.0]


def test_kpis_first_growth_is_null_and_totals_close(spark):
    members = spark.createDataFrame([("m1", "annual", "Active", date(2022, 1, 1), date(2022, 1, 2), date(2022, 1, 3), None, None), ("m2", "monthly", "Churned", date(2022, 1, 2), None, None, None, date(2022, 1, 9))],
                                    "member_id string, membership_type string, member_status string, membership_start_dt date, first_item_order_dt date, first_delivery_dt date, last_pick_up_dt date, membership_end_dt date")
    out = spark.createDataFrame([("m1", date(2022, 1, 3), None, 10.0)], "member_id string, delivery_date date, pick_up_date date, avg_price double")
    off = spark.createDataFrame([("m1", date(2022, 1, 2), date(2022, 1, 5), -3.0)], "member_id string, start_date date, end_date date, discount_mrr_offset double")
    got = kpis.kpis_by_day(members, out, off, "2022-01-01", "2022-01-10").orderBy("date").collect()
    assert len(got) == 10 and all(r.current_member_7d_growth_pct is None for r in got[:7])
    assert [r.current_members for r in got] == [1, 2, 2, 2, 2, 2, 2, 2, 1, 1]
    assert got[7].current_member_7d_growth_pct == pytest.approx(1.0)
    assert [r.active_rental_mrr_net for r in got][:6] == [0.0, -3.0, 7.0, 7.0, 10.0, 10.0]
    long = kpis.kpi_long(kpis.kpis_by_day(members, out, off, "2022-01-01", "2022-01-10"))
    assert long.count() == 10 * 4 * 4


def test_spines(spark):
    assert [r.date for r in calendar.day_spine(spark, "2024-02-27", "2024-03-01").collect()] == [date(2024, 2, 27), date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    assert [r.month.month for r in calendar.month_spine(spark, "2024-01-15", "2024-03-01").collect()] == [1, 2, 3]
    assert [r.ordinal for r in calendar.number_spine(spark, 3).collect()] == [0, 1, 2]
    df = spark.createDataFrame([("a", 3), ("b", 0), ("c", None)], "k string, q int")
    assert rows(calendar.expand_units(df, "q"), "k", "unit") == [("a", 1), ("a", 2), ("a", 3)]
