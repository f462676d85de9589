"""Sessions, channels and attribution on edge rows and against brute force."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from leasewise.operators import attribution, ordered, web

T0 = datetime(2024, 1, 1, 12, 0, 0)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def brute_sessions(events, gap):
    """(id -> session id), one actor at a time."""
    out = {}
    for actor in {e[0] for e in events}:
        last, session = None, None
        for _, ts, i in sorted((e for e in events if e[0] == actor), key=lambda e: (e[1], e[2])):
            second = int(ts.timestamp())
            if last is None or second - last > gap:
                session = i
            out[i], last = session, second
    return out


def test_gap_bounds(spark):
    # 1800 s stays, 1801 s cuts, 1800.2 s over a second boundary cuts.
    events = [("a", at(0), 1), ("a", at(1800), 2), ("a", at(3601), 3), ("b", at(0.9), 4), ("b", at(1801.1), 5), (None, at(5), 6), (None, at(9), 7), ("c", at(0), 8), ("c", None, 9), ("n", None, 10), ("n", None, 11)]
    df = spark.createDataFrame(events, "actor string, ts timestamp, id long")
    got = dict(rows(web.sessionize(df, "actor", "ts", "id"), "id", "session_id"))
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, 9: 8, 10: 10, 11: 10}


@pytest.mark.parametrize("hot_rows,chunk_rows", [(10**6, 10**6), (100, 1), (100, 7), (10, 40), (0, 3), (0, 10**6)])
def test_hot_actor_matches_brute_force(spark, hot_rows, chunk_rows):
    # One actor holds most rows, many have none; chunks of any size give the same sessions.
    rng, events, sec = random.Random(chunk_rows), [], 0
    for i in range(1500):
        sec += rng.choice([0, 1, 5, 300, 1799, 1800, 1801, 9000])
        who = "hot" if rng.random() < 0.6 else None if rng.random() < 0.5 else f"u{rng.randrange(20)}"
        events.append((who, at(sec + rng.choice([0, 0.5])), i))
    df = spark.createDataFrame(events + [(a, None, 2000 + k) for k, a in enumerate(["hot", "hot", None, "u1", "never"])], "actor string, ts timestamp, id long").repartition(4)
    got = dict(rows(web.sessionize(df, "actor", "ts", "id", 1800, hot_rows, chunk_rows), "id", "session_id"))
    want = brute_sessions(events, 1800)
    last = lambda a: want[max((e[1], e[2]) for e in events if e[0] == a)[1]]
    assert got == want | {2000: last("hot"), 2001: last("hot"), 2002: last(None), 2003: last("u1"), 2004: 2004}


def test_no_task_holds_a_hot_actor(spark):
    """One actor has 90 % of all events: chunks are bounded, and no task of the window has over twice the median."""
    events = spark.range(60_000).select(
        F.when(F.col("id") % 10 > 0, "bot").otherwise(F.concat(F.lit("u"), F.col("id") % 400)).alias("actor"),
        F.timestamp_seconds(F.col("id") * 977 % 60_000 * 60).alias("ts"), "id")
    with_parts = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in with_parts}
    for k, v in with_parts.items():
        spark.conf.set(k, v)
    try:
        cold, hot = ordered.split_hot(events, ["actor"], [F.col("ts"), F.col("id")], 5_000, 300)
        sizes = [r[0] for r in hot.groupBy("actor", "_chunk").count().select("count").collect()]
        assert sum(sizes) == 54_000 and max(sizes) <= 300 and cold.filter("actor = 'bot'").isEmpty()
        out = web.sessionize(events, "actor", "ts", "id", 1800, 5_000, 300)
        tasks = sorted(r[0] for r in out.filter("actor = 'bot'").groupBy(F.spark_partition_id()).count().select("count").collect())
        assert len(tasks) >= 8 and tasks[-1] <= 2 * tasks[len(tasks) // 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def brute_weights(n):
    return [1.0] if n == 1 else [0.5, 0.5] if n == 2 else [0.25] + [0.5 / (n - 2)] * (n - 2) + [0.25]


def test_attribution_counts_and_bounds(spark):
    conversions = [(f"c{n}", f"m{n}", T0) for n in (0, 1, 2, 3, 5)] + [("edge", "m9", T0)]
    touches = [(n * 10 + i, f"m{n}", T0 - timedelta(hours=i), "google_search" if i else None, None) for n in (1, 2, 3, 5) for i in range(n)]
    # Both ends of the window are in it; a second outside is not.
    touches += [(901, "m9", T0 - timedelta(hours=4320), "x", "k"), (902, "m9", T0 + timedelta(hours=24), "y", None),
                (903, "m9", T0 - timedelta(hours=4320, seconds=1), "out", None), (904, "m9", T0 + timedelta(hours=24, seconds=1), "out", None)]
    c = spark.createDataFrame(conversions, "conversion_id string, member_id string, order_ts timestamp")
    t = spark.createDataFrame(touches, "event_id long, member_id string, event_ts timestamp, channel_id string, campaign_id string")
    out = attribution.attribute(c, t)
    weights = {}
    for conv, ts, w in rows(out.orderBy("event_ts"), "conversion_id", "event_ts", "multi_touch_weighting"):
        weights.setdefault(conv, []).append((ts or T0, w))
    for n in (0, 1, 2, 3, 5):
        assert [w for _, w in sorted(weights[f"c{n}"])] == pytest.approx(brute_weights(max(n, 1)))
    assert len(weights["edge"]) == 2
    sums = out.groupBy("conversion_id").agg(*[F.round(F.sum(f"{k}_weighting"), 9).alias(k) for k in ("first_touch", "last_touch", "multi_touch")])
    assert all(r[1:] == (1.0, 1.0, 1.0) for r in rows(sums))
    lonely = out.filter("conversion_id = 'c0'").collect()[0]
    assert (lonely.channel_id, lonely.campaign_id, lonely.event_id) == ("direct", "no campaign", None)
    assert attribution.attribute(c, t, how="inner").filter("conversion_id = 'c0'").count() == 0
    assert rows(attribution.attribute(c, t, slot_days=1)) == rows(out)


def test_order_attribution(spark):
    orders = spark.createDataFrame([("o1", "m", T0), ("o2", "m", T0 + timedelta(days=1)), ("o3", None, T0)], "order_id string, member_id string, order_ts timestamp")
    visits = spark.createDataFrame([(1, "m", T0 - timedelta(hours=8760), "a", None), (2, "m", T0 + timedelta(seconds=1), "b", "k")],
                                   "session_id long, member_id string, session_start_ts timestamp, session_channel_id string, session_campaign_name string")
    got = rows(attribution.order_channel_credit(orders, visits), "order_id", "channel_id", "touches", "multi_touch")
    assert got == [("o1", "a", 1, 1.0), ("o2", "b", 1, 1.0)]
    got = rows(attribution.order_attribution(orders, visits), "order_id", "event_id", "channel_id", "campaign_id", "multi_touch_weighting")
    assert got == [("o1", 1, "a", "no campaign", 1.0), ("o2", 2, "b", "k", 1.0)]


def test_every_channel_counts(spark):
    """Four touches, the first of a channel seen nowhere else: weights still sum to 1."""
    c = spark.createDataFrame([("c", "m", T0)], "conversion_id string, member_id string, order_ts timestamp")
    t = spark.createDataFrame([(i, "m", T0 - timedelta(hours=9 - i), ch, None) for i, ch in enumerate(["rare", "a", None, "a"])],
                              "event_id long, member_id string, event_ts timestamp, channel_id string, campaign_id string")
    got = {r[0]: r[1:] for r in rows(attribution.channel_credit(c, t), "channel_id", "touches", "first_touch", "last_touch", "multi_touch")}
    assert got == {"rare": (1, 1.0, 0.0, 0.25), "a": (2, 0.0, 1.0, 0.5), "direct": (1, 0.0, 0.0, 0.25)}


def test_channel_rules_in_order(spark):
    cases = [
        ((1, "adwords_display", 1, "facebook", "cpc", None), "adwords_display"), ((1, None, 1, None, None, None), "adwords_search"),
        ((0, None, 1, "facebook", "cpc", None), "referral"), ((0, None, 0, "Facebook", "cpc", "https://l.instagram.com"), "instagram_ads"),
        ((0, None, 0, "facebook", "cpc", "https://google.com"), "facebook_ads"), ((0, None, 0, "club", None, "https://google.com"), "sc_club"),
        ((0, None, 0, "liveintent", "cpc", None), "liveintent"), ((0, None, 0, "facebook", None, "https://www.bing.com"), "bing_search"),
        ((0, None, 0, None, None, "https://shop.example.com/a"), "internal"), ((0, None, 0, None, None, None), "direct")]
    df = spark.createDataFrame([(*c, i) for i, (c, _) in enumerate(cases)],
                               "session_has_gclid int, ad_channel_id string, is_referral_session int, session_campaign_source string, session_campaign_medium string, session_referrer string, i int")
    got = dict(rows(web.classify_channel(df, {"club": "sc_club"}), "i", "session_channel_id"))
    assert got == {i: want for i, (_, want) in enumerate(cases)}


@pytest.mark.parametrize("hot_rows,chunk_rows", [(10**6, 10**6), (50, 1), (50, 9), (0, 200)])
def test_credit_without_pairs_equals_credit_from_pairs(spark, hot_rows, chunk_rows):
    # One member holds half of the conversions and of the touches.
    rng = random.Random(chunk_rows)
    who = lambda: "hot" if rng.random() < 0.5 else f"m{rng.randrange(6)}"
    when = lambda: T0 + timedelta(hours=rng.randrange(24 * 40), seconds=rng.choice([0, 0, 1]))
    c = spark.createDataFrame([(i, who(), when()) for i in range(120)] + [(900, "alone", T0), (901, None, T0)], "conversion_id long, member_id string, order_ts timestamp")
    t = spark.createDataFrame([(i, who(), when(), rng.choice(["a", "b", "c", None]), None) for i in range(400)], "event_id long, member_id string, event_ts timestamp, channel_id string, campaign_id string")
    kinds = ("first_touch", "last_touch", "multi_touch")
    whole = attribution.attribute(c, t, 96, 5)
    assert rows(attribution.attribute(c, t, 96, 5, hot_rows=hot_rows, chunk_rows=chunk_rows)) == rows(whole)
    pairs = whole.groupBy("conversion_id", "channel_id").agg(
        F.count("event_id").alias("touches"), *[F.round(F.sum(f"{k}_weighting"), 9).alias(k) for k in kinds])
    plain = attribution.channel_credit(c, t, 96, 5, hot_rows, chunk_rows).select("conversion_id", "channel_id", "touches", *[F.round(k, 9).alias(k) for k in kinds])
    assert rows(plain) == rows(pairs)


def test_lookup_takes_maps_and_null_keys(spark):
    from leasewise.operators.ordered import lookup
    left = spark.createDataFrame([(1, "a", {"x": 1}), (2, None, {"y": 2}), (3, "z", None)], "id int, k string, m map<string,int>")
    right = spark.createDataFrame([("a", "A"), (None, "never")], "k string, name string")
    want = [(1, "A"), (2, None), (3, None)]
    assert rows(lookup(left, right, "k"), "id", "name") == want
    assert rows(lookup(left, right, "k", ["id"]), "id", "name") == want


def test_development_sessions_do_not_mark_a_visitor(spark):
    """Module flags and device come from kept sessions; the first visit from all."""
    home, shop = "https://shop.example.com/", "https://shop.example.com/?pf_c_collection="
    events = [
        (1, "u", at(0), "https://shop-dev.example.com/?pf_c_collection=1", home, "iPhone"), (2, "u", at(10_000), shop + "2", home, "Android"),
        (3, "v", at(0), "https://shop-dev.example.com/?pf_c_collection=1", home, "iPhone"), (4, "w", at(5), shop + "1&y=2", home, None)]
    cols = "id long, master_user_id string, timestamp timestamp, url string, context_page_referrer string, context_user_agent string"
    df = spark.createDataFrame(events, cols).withColumns({c: F.lit(None).cast("string") for c in (
        "anonymous_id", "user_id", "email", "product_id", "referrer", "context_ip", *[f"context_campaign_{c}" for c in web.CAMPAIGN])}).withColumn("src_tbl", F.lit("pages"))
    none = lambda schema: spark.createDataFrame([], schema)
    out = web.enrich_sessions(
        web.sessionize(df, "master_user_id", "timestamp", "id"), none("src_id string, src string, email_key string, member_id string"),
        members=none("member_id string, membership_start_dt date"), products=none("id string, handle string"),
        campaigns=none("campaign_id string, src_campaign_id string, channel_id string"), clicks=none("gcl_id string, campaign_id string"),
        geo=none("ip_id string, region string, country string, city string"), exclusions=none("kind string, value string"), modules={"one": "1", "two": "2"})
    got = {r.id: (r.is_one_module, r.is_two_module, r.session_device_type, r.user_first_visit_ts) for r in out.collect()}
    assert got == {2: (0, 1, "Android", at(0)), 4: (1, 0, None, at(5))}
