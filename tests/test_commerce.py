"""Identity, ordered helpers, JSON, ledger and baskets on edge rows."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from leasewise.functions import exprs
from leasewise.operators import commerce, identity, ordered, quality, web

D = Decimal


def test_identity_edges(spark):
    people = spark.createDataFrame([("1", " Ann@X.org"), ("2", "ann@x.org "), ("3", "bob@x.org"), ("4", None)], "id string, email string")
    crm = spark.createDataFrame([("h1", "ANN@x.org")], "id string, email string")
    seen = spark.createDataFrame([("d1", "3", datetime(2024, 1, 2)), ("d1", "1", datetime(2024, 1, 1)), ("d2", "9", datetime(2024, 1, 1)), (None, "1", datetime(2024, 1, 1))],
                                 "anonymous_id string, user_id string, timestamp timestamp")
    forced = spark.createDataFrame([("shopify", "2", "merged"), ("hubspot", "2", "no")], "src string, src_id string, member_id string")
    idmap = identity.identity_map(people, crm, seen, seen.limit(0), forced)
    got = {(r.src, r.src_id): (r.email_key, r.member_id) for r in idmap.collect()}
    ann = got["shopify", "1"][0]
    assert got["shopify", "2"] == (ann, "merged") and got["hubspot", "h1"] == (ann, ann) and got["shopify", "4"] == (None, None)
    assert got["segment", "d1"] == (ann, ann) and ("segment", "d2") not in got
    assert sorted(r.member_id for r in identity.email_lookup(idmap).filter(F.col("email_key") == ann).collect()) == sorted([ann, "merged"])
    events = spark.createDataFrame([("d1", "3", 1), ("dx", "3", 2), ("dx", "77", 3), ("dx", None, 4), (None, None, 5)], "anonymous_id string, user_id string, i int")
    actors = dict(rows(identity.resolve_actor(events, idmap), "i", "master_user_id"))
    assert actors == {1: ann, 2: got["shopify", "3"][1], 3: "77", 4: "dx", 5: None}


def test_money_and_ids(spark):
    df = spark.createDataFrame([("",), (" ",), ("$1,234.50",), ("12.9",), ("abc",), (None,), ("123.0",)], "t string")
    got = [tuple(r) for r in df.select(exprs.parse_number("t"), exprs.parse_whole("t"), exprs.number_id("t")).collect()]
    assert got == [(None, None, ""), (None, None, ""), (1234.5, 1234, "$1,234"), (12.9, 12, "12"), (None, None, ""), (None, None, None), (123.0, 123, "123")]


@pytest.mark.parametrize("total,label", [(49.99, "< 50"), (50, "50 - 100"), (100, "100 - 150"), (150, "150 - 200"), (200, "200+"), (None, None)])
def test_bins(spark, total, label):
    df = spark.createDataFrame([(total if total is None else float(total),)], "v double")
    assert df.select(exprs.binned("v", (50, 100, 150, 200))).collect()[0][0] == label


def skewed(spark, n=3000):
    """A third of all rows, and of the nulls, under one key."""
    rng = random.Random(7)
    data = [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{rng.randrange(50)}", datetime(2024, 1 + rng.randrange(12), 1 + rng.randrange(28)), i) for i in range(n)]
    return data, spark.createDataFrame(data, "k string, ts timestamp, id int").repartition(5)


def test_ordered_helpers_on_a_hot_key(spark):
    data, df = skewed(spark)
    groups = {}
    for k, ts, i in data:
        groups.setdefault(k, []).append((ts, i))
    want = {i: n for g in groups.values() for n, (_, i) in enumerate(sorted(g), 1)}
    for bounds in ((10**6, 10**6), (100, 1), (100, 33), (0, 500)):
        assert dict(rows(ordered.numbered(df, "k", "ts", ["id"], "rn", *bounds), "id", "rn")) == want
    for salts in (1, 3, 64):
        flagged = ordered.flag_first(df, "k", ["ts", "id"], "f", salts)
        assert {i for i, f in rows(flagged, "id", "f") if f} == {i for i, n in want.items() if n == 1} and flagged.count() == len(data)
    assert {r[0] for r in rows(ordered.first_rows(df, "k", ["ts", "id"], 2), "id")} == {i for i, n in want.items() if n <= 2}
    every = dict(rows(ordered.numbered_all(df, ["ts", "id"]), "id", "rn"))
    assert every == {i: n for n, (_, i) in enumerate(sorted((ts, i) for _, ts, i in data), 1)}


def test_lookup_keeps_all_rows(spark):
    data, df = skewed(spark)
    names = spark.createDataFrame([("hot", "H"), ("k1", "one"), (None, "never")], "k string, name string")
    out = ordered.lookup(df, names, "k")
    assert out.count() == len(data)
    assert {r.k: r.name for r in out.filter("name is not null").collect()} == {"hot": "H", "k1": "one"}


def test_first_rows_are_cut_before_the_shuffle(spark):
    _, df = skewed(spark)
    plan = ordered.first_rows(df, "k", ["ts", "id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def orders(spark, extra=()):
    data = [("1", '{"id":"c"}', '[{"code":"A","amount":"2.50","type":"fixed"},{"code":"B","amount":"x"}]',
             '[{"id":"r","order_id":"1","restock":true,"order_adjustments":[{"amount":"5"}],"refund_line_items":[{"id":"x","line_item_id":"l1","quantity":1,"subtotal":"7.00"},{"id":"y"}]}]'),
            ("2", None, "[]", "[]"), ("3", "{}", None, None), ("4", '{"id":""}', "not json", "not json"), *extra]
    return spark.createDataFrame(data, "id string, customer string, discount_codes string, refunds string")


def test_json_unnest_edges(spark):
    idmap = spark.createDataFrame([("c", "shopify", "m")], "src_id string, src string, member_id string")
    codes = rows(commerce.order_codes(orders(spark)), "order_id", "ordinal", "discount_code", "discount_amount")
    assert codes == [("1", 0, "A", D("2.50")), ("1", 1, "B", None)]
    refunds = commerce.fact_refund(orders(spark), idmap)
    assert rows(refunds, "refund_id", "member_id", "restock", "order_adjustments", "created_ts") == [("r", "m", True, D("5.00"), None)]
    lines = rows(commerce.fact_refund_line_item(refunds), "refund_line_item_id", "line_item_id", "quantity", "subtotal")
    assert lines == [("x", "l1", 1, D("7.00")), ("y", None, None, None)]


def test_long_array_is_not_capped(spark):
    many = "[" + ",".join(f'{{"code":"C{i}","amount":"1"}}' for i in range(6000)) + "]"
    df = orders(spark, [("9", None, many, None)]).filter("id = '9'")
    assert commerce.order_codes(df).count() == 6000


def test_ledger_rows_and_signs(spark):
    heads = spark.createDataFrame([("1", "m", datetime(2024, 1, 1), 11, "web", None), ("2", "m", datetime(2024, 1, 2), 12, "odd", D("1.00"))],
                                  "order_id string, member_id string, order_ts timestamp, order_number int, order_type string, order_tax decimal(18,2)")
    lines = spark.createDataFrame([("l1", "1", D("10.00"), 2, "s1", D("1.00")), ("l2", "2", D("4.00"), 1, "gone", D("0.00"))],
                                  "line_item_id string, order_id string, price decimal(18,2), quantity int, sku string, total_discount decimal(18,2)")
    refunds = spark.createDataFrame([("r1", "1", "m", datetime(2024, 2, 1), D("90.00")), ("r2", "2", "m", datetime(2024, 2, 2), D("-3.00"))],
                                    "refund_id string, order_id string, member_id string, created_ts timestamp, order_adjustments decimal(18,2)")
    back = spark.createDataFrame([("r1", "1", "l1", 2, D("19.00"), D("0.50"), None)],
                                 "refund_id string, order_id string, line_item_id string, quantity int, subtotal decimal(18,2), total_tax decimal(18,2), total_discount decimal(18,2)")
    products = spark.createDataFrame([("s1", "Annual Membership")], "sku string, product_name string")
    ledger = commerce.fact_transaction(heads, lines, refunds, back, products)
    got = rows(ledger, "order_id", "sales_type", "line_item_id", "sku", "quantity", "net_sales", "sales_channel")
    assert got == sorted([
        ("1", "order", "l1", "s1", 2, D("19.00"), "Online Store"), ("2", "order", "l2", None, 1, D("4.00"), None), ("1", "return", "l1", "s1", -2, D("-19.00"), "Online Store"),
        ("2", "return", None, None, None, D("-3.00"), None), ("1", "return", None, None, 0, D("90.00"), "Online Store")], key=str)
    assert rows(commerce.special_members(ledger)) == [("m",)]


def test_gift_only_orders(spark):
    lines = spark.createDataFrame([("1", "g", "x"), ("1", "g", "x"), ("2", "g", "x"), ("2", "p", "x"), ("3", None, "A Gift Card"), ("4", None, None)], "order_id string, product_id string, name string")
    products = spark.createDataFrame([("g", "Gift Card 50"), ("p", "Crib")], "id string, title string")
    assert rows(commerce.gift_card_orders(lines, products)) == [("1",), ("3",)]


def test_baskets_tie_on_time(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 5, 1)
    heads = spark.createDataFrame([("1", "m", t1, "web"), ("2", "m", t1, "web"), ("3", "m", t2, "web"), ("4", "m", t2, "subscription_contract")], "order_id string, member_id string, order_ts timestamp, order_type string")
    lines = spark.createDataFrame([("1", "a", D("30.00"), 2, D("1.00")), ("2", "a", D("40.00"), 1, D("0.00")), ("3", "z", D("5.00"), 1, D("0.00"))],
                                  "order_id string, sku string, price decimal(18,2), quantity int, total_discount decimal(18,2)")
    products = spark.createDataFrame([("a", "Crib")], "sku string, product_name string")
    got = rows(commerce.baskets_orders(heads, lines, products, "a"), "dense_rank", "basket_ct", "basket_dollars", "basket_bin", "has_flagship", "basket_products")
    assert got == [(1, 2, D("100.00"), "100 - 150", 1, "Crib, Crib"), (2, 1, None, None, 0, None)]


def test_fulfilment_units(spark):
    lines = spark.createDataFrame([(str(i), D("1.00"), q, "t", D("0"), "v", "n", p, str(i)) for i, (q, p) in enumerate([(1, "p"), (12, "b"), (None, "p2"), (0, "p3")])],
                                  "id string, price decimal(18,2), quantity int, title string, total_discount decimal(18,2), variant_id string, name string, product_id string, order_id string")
    heads = spark.createDataFrame([(str(i), '{"id":"c"}', "web", datetime(2024, 1, 1)) for i in range(4)], "id string, customer string, source_name string, created_at timestamp")
    bundles = spark.createDataFrame([("b", "Part", "b2")], "product_id string, extra_name string, extra_product_id string")
    out = commerce.fulfilment_lines(lines, heads, bundles)
    assert out.count() == 1 + 24 + 1 + 1 and out.filter("product_id = 'b2' and price = 0").count() == 12
    assert {"1", "2-1", "12-1", "9.1", "9.12-1"} <= {r.id for r in out.collect()}  # one rule for all units
    assert quality.check_unique(out, "id").count() == 0


def test_registry_pairs(spark):
    props = '[{"name":"a","value":"1"},{"name":"_r","value":"{\\"registrantId\\":\\"7\\"}"}]'
    lines = spark.createDataFrame([("l", "1", 1.0, "p", "v", "registry", props), ("k", "1", 1.0, "p", "v", "manual", props), ("n", "1", 1.0, "p", "v", "registry", "bad")],
                                  "id string, order_id string, price double, product_id string, variant_id string, fulfillment_service string, properties string")
    people = spark.createDataFrame([("c", "A@x.org"), ("7", "b@x.org")], "id string, email string")
    got = rows(web.registry_pairs(lines, orders(spark), people), "line_item_id", "customer_email", "recipient_shopify_id", "recipient_email")
    assert got == [("l", "A@x.org", "7", "b@x.org"), ("n", "A@x.org", None, None)]


def test_quality(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert rows(quality.check_unique(df, "k")) == [("a", 2)] and quality.check_not_null(df, "k").count() == 2
    assert quality.check_row_count(df, 5) and not quality.check_row_count(df, 6) and quality.check_row_count(df.limit(0), 0, 0)
    assert not quality.check_row_count(df, 0, 4)
