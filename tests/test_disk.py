"""Disk: what a model leaves behind while others are built."""

import glob
import os
import time

from conftest import rows
from pyspark.sql import functions as F

from leasewise import session
from leasewise.operators.ordered import lookup
from leasewise.plans import bindings

SF_DIR = "/root/testdata/sf0.001"


def shuffle_files(spark):
    """Names of the shuffle files that the session's tasks have on disk."""
    root = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in root for f in glob.glob(f"{top}/*/shuffle_*")}


def cuts(spark):
    return set(glob.glob(f"{session._cuts(spark).removeprefix('file:')}/*"))


def test_no_shuffle_file_outlives_a_lean_cut(spark):
    before = shuffle_files(spark)
    df = spark.range(20_000).withColumn("k", F.col("id") % 7).repartition(4, "k")
    kept = session.cut_lean(df)
    for _ in range(40):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    assert not left
    assert kept.count() == 20_000 and df.groupBy("k").count().count() == 7  # the rows can be dealt again
    assert spark.conf.get(session._PASSING, "false") == "false"


def test_steps_go_with_the_table_they_are_made_for(spark):
    before, forgotten = cuts(spark), []
    with session.steps():
        step = session.cut_step(spark.range(10), lambda: forgotten.append("outer"))
        with session.steps():
            inner = session.cut_step(spark.range(5))
            made = session.cut_lean(inner.unionAll(inner))
        assert step.count() == 10 and not forgotten
    assert forgotten == ["outer"] and len(cuts(spark) - before) == 1 and made.count() == 10
    assert session.cut_step(spark.range(3)).count() == 3 and len(cuts(spark) - before) == 2  # outside it stays


def test_lookups_by_one_text_key_deal_the_rows_once(spark, frame):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = frame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "k string, n int")
        one, two = frame([("a", "x"), (None, "none")], "k string, v string"), frame([("a", "p"), ("a", "q"), ("c", "r")], "k string, w string")
        out = lookup(lookup(left, one, "k"), two, "k")
        plan = out._jdf.queryExecution().sparkPlan().toString() and out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(") == 3  # each table once
        assert out.columns == ["k", "n", "v", "w"]
        assert rows(out) == sorted([("a", 1, "x", "p"), ("a", 1, "x", "q"), ("a", 4, "x", "p"), ("a", 4, "x", "q"), ("b", 2, None, None), (None, 3, None, None)], key=str)
        by_two = lookup(frame([(1, "s", "u"), (2, None, "u")], "n int, a string, b string"), frame([("s", "u", 5)], "a string, b string, c int"), ["a", "b"])
        assert by_two.columns == ["b", "n", "a", "c"] and rows(by_two) == [("u", 1, "s", 5), ("u", 2, None, None)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_model_leaves_its_own_table_only(spark):
    w = bindings.TestWarehouse(spark, SF_DIR)
    for key in [k for k in bindings._kept if k[1] == SF_DIR]:  # built anew here
        bindings._kept.pop(key)
    w.idmap
    before = cuts(spark)
    assert w.rentals.count() > 0
    assert len(cuts(spark) - before) == 1 and not [k for k in bindings._kept if k[2] in bindings.WRITTEN]
    w.orders, w.lines
    before = cuts(spark)
    assert w.ledger.count() > 0
    assert len(cuts(spark) - before) == 1


def test_cohort_months_are_not_shuffled(spark, frame):
    """Rentals of many months move as rentals; equal rows lead a month once."""
    from leasewise.operators import kpis
    rentals = frame(
        [("m", None, "s2", "1995-01-10", None, 5), ("m", "b", "s1", "1995-03-05", "1995-05-02", 7), ("m", "b", "s1", "1995-03-05", "1995-05-02", 7), (None, "z", "s1", "1995-01-01", None, 9)],
        "member_id string, line_item_id string, sku string, delivery_date string, pick_up_date string, avg_price int").selectExpr(
        "member_id", "line_item_id", "sku", "date(delivery_date) delivery_date", "date(pick_up_date) pick_up_date", "cast(avg_price as decimal(18,2)) avg_price")
    members = spark.sql("""SELECT 'm' member_id, 'monthly' membership_type, DATE'1995-01-01' membership_start_dt, DATE'1994-01-01' youngest_child_dob,
                           1 number_of_children, 'no' expecting_at_sign_up, false is_shared_offer""")
    offsets = spark.sql("SELECT 'm' member_id, DATE'1995-02-20' start_date, DATE'1995-05-21' end_date, CAST(-2 AS DECIMAL(18,2)) discount_mrr_offset")
    baskets = spark.sql("SELECT 'm' member_id, 'x' basket_bin, 1 basket_ct, CAST(1 AS DECIMAL(18,2)) basket_dollars, 1 has_flagship")
    out = kpis.cohort_base(rentals, members, offsets, baskets, "1995-01-01", "1995-06-15")
    got = sorted((str(r.month)[:7], r.sku, float(r.membership_mrr), float(r.discount_offset)) for r in out.collect())
    assert got == sorted([
        ("1995-01", "s2", 18, 0), ("1995-02", "s2", 18, 0), ("1995-03", "s2", 0, 0), ("1995-04", "s2", 0, 0), ("1995-05", "s2", 0, 0), ("1995-06", "s2", 18, 0),
        ("1995-03", "s1", 18, -2), ("1995-03", "s1", 0, 0), ("1995-04", "s1", 18, -2), ("1995-04", "s1", 0, 0), ("1995-05", "s1", 18, -2), ("1995-05", "s1", 0, 0)])
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
