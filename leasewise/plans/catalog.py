"""The registered queries: a Spark form, and a SQL form to check it with.

A query lists its output columns with a kind each, from which both forms make
the same plain values: s text, b boolean, i bigint, m money (double), f double
rounded to 6 places, d date and t timestamp as text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import calendar, exprs
from ..operators import ads, attribution, commerce, distinct, identity, kpis, lifecycle, ordered, quality, rentals, web
from ..sources import conform, daytables, export, incremental, payload, tables, variants
from ..session import checkpoint_dir, cut, cut_lean
from ..sources.spec import Field, TableSpec
from .bindings import K, LINE, SETTINGS, TestWarehouse
from .oracle import AS_OF, FIRST, oracle, sessions_sql

SPARK_KINDS = {
    "s": lambda c: c.cast("string"), "b": lambda c: c.cast("boolean"), "i": lambda c: c.cast("bigint"), "m": lambda c: c.cast("double"),
    "f": lambda c: F.round(c.cast("double"), 6), "d": lambda c: c.cast("date").cast("string"), "t": lambda c: c.cast("timestamp").cast("string"),
}
SQL_KINDS = {
    "s": "CAST({0} AS VARCHAR)", "b": "CAST({0} AS BOOLEAN)", "i": "CAST({0} AS BIGINT)", "m": "CAST({0} AS DOUBLE)",
    "f": "round(CAST({0} AS DOUBLE), 6)", "d": "CAST(CAST({0} AS DATE) AS VARCHAR)", "t": "CAST(CAST({0} AS TIMESTAMP) AS VARCHAR)",
}


@dataclass(frozen=True)
class Query:
    columns: tuple[tuple[str, str], ...]
    build: Callable[[TestWarehouse], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(TestWarehouse(spark, sf_dir))
        return df.select(*[SPARK_KINDS[k](F.col(f"`{n}`")).alias(n) for n, k in self.columns])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        body = self.sql if self.sql.lstrip().upper().startswith(("SELECT", "WITH", "UNPIVOT")) else f"SELECT * FROM {self.sql}"
        cols = ", ".join(f"{SQL_KINDS[k].format(n)} AS {n}" for n, k in self.columns)
        return oracle(f"SELECT {cols} FROM ({body}) AS q")


CATALOG: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None):
    """Register a query: columns as 'name:kind ...', then its Spark form."""
    parsed = tuple((p.rpartition(":")[0], p.rpartition(":")[2]) for p in columns.split())

    def add(build):
        CATALOG[name] = Query(parsed, build, sql)
        return build

    return add


def cols(names: str, kind: str) -> str:
    return " ".join(f"{n}:{kind}" for n in names.split())


# --- sessions --------------------------------------------------------------

SESSION_COLUMNS = "session_id:i user_id:i session_start_ts:t session_end_ts:t event_count:i first_kind:s is_bounce:b"
for _name, _gap in (("sessionize_30m", 1800), ("sessionize_6h", 21600)):
    def _sessions(w, gap=_gap):
        ev = w.table("events").select("user_id", "ts", "event_id", "event_type")
        return web.session_table(web.sessionize(ev, "user_id", "ts", "event_id", gap), "user_id", "ts", "event_id", "event_type")

    query(_name, SESSION_COLUMNS, f"""
        SELECT session_id, min(user_id) AS user_id, min(ts) AS session_start_ts, max(ts) AS session_end_ts, count(*) AS event_count,
               first(event_type ORDER BY ts, event_id) AS first_kind, count(*) = 1 AS is_bounce
        FROM ({sessions_sql('events', 'user_id', 'ts', 'event_id', _gap)}) GROUP BY 1""")(_sessions)

CAMPAIGN_COLUMNS = cols("session_campaign_name session_campaign_content session_campaign_source session_campaign_medium", "s")
query("session_flags", f"session_id:i {CAMPAIGN_COLUMNS} session_referrer:s session_has_gclid:i session_gcl_id:s is_referral_session:i "
      "session_start_ts:t session_end_ts:t is_dev_session:i session_page_views:i session_first_url:s is_bounce_session:b",
      "SELECT *, session_page_views = 1 AS is_bounce_session FROM o_session_attributes")(
    lambda w: web.session_attributes(w.sessioned))

query("known_actor", "id:i master_user_id:s", "o_known")(lambda w: identity.resolve_actor(w.source("events"), w.idmap))

_WEB = ("anonymous_id:s user_id:s created_at:t url:s referrer:s context_ip:s context_user_agent:s context_page_referrer:s context_campaign_name:s context_campaign_content:s "
        "context_campaign_source:s context_campaign_medium:s email:s product_id:s registry_customer_id:s session_campaign_content:s session_campaign_source:s session_campaign_medium:s session_referrer:s "
        "session_has_gclid:i session_gcl_id:s is_referral_session:i session_end_ts:t session_page_views:i session_first_url:s "
        + " ".join(f"user_{e}_session_campaign_{c}:s" for e in ("first", "last") for c in ("name", "content", "source", "medium")) + " "
        "session_id:i id:i timestamp:t src_tbl:s master_user_id:s member_id:s membership_state:s is_internal:b session_channel_id:s session_campaign_name:s "
        "session_start_ts:t user_first_visit_ts:t user_first_session_channel_id:s user_last_session_channel_id:s session_device_type:s is_one_module:i is_two_module:i "
        "product_id_master:s campaign_id:s ip_region:s ip_country:s ip_city:s")
query("web_activity", _WEB, "o_web")(lambda w: w.web)

query("touch_attributes", "master_user_id:s " + " ".join(
    f"user_{e}_session_{c}:s" for e in ("first", "last") for c in ("channel_id", "campaign_name", "campaign_content", "campaign_source", "campaign_medium")),
    "SELECT * FROM o_touches WHERE master_user_id IN (SELECT master_user_id FROM o_web)")(
    lambda w: w.web.groupBy("master_user_id").agg(*[
        F.first(f"user_{e}_session_{c}").alias(f"user_{e}_session_{c}")
        for e in ("first", "last") for c in ("channel_id", "campaign_name", "campaign_content", "campaign_source", "campaign_medium")]))

query("classify_channel", "session_channel_id:s sessions:i",
      "SELECT session_channel_id, count(DISTINCT session_id) AS sessions FROM o_web GROUP BY 1")(
    lambda w: w.web.groupBy("session_channel_id").agg(F.countDistinct("session_id").alias("sessions")))

query("module_flags", "master_user_id:s is_one_module:i is_two_module:i", "SELECT master_user_id, is_one_module, is_two_module FROM o_visitors WHERE master_user_id IN (SELECT master_user_id FROM o_web)")(
    lambda w: w.web.groupBy("master_user_id").agg(*web.module_flags(SETTINGS.modules, "https://shop.example.com/")))

_PRODUCT_EVENT = "product_name:s sku:s timestamp:t session_start_ts:t user_id:s url:s session_id:i user_first_session_channel_id:s session_channel_id:s"
_EVENT_SQL = """
    SELECT p.product_name, p.sku, w.timestamp, w.session_start_ts, w.master_user_id AS user_id, w.url, w.session_id, w.user_first_session_channel_id, w.session_channel_id
    FROM o_web w JOIN o_products p ON p.sku = w.product_id JOIN (
        SELECT session_id, {flags} FROM o_web WHERE NOT is_internal GROUP BY 1) f ON f.session_id = w.session_id WHERE w.src_tbl = '{kind}' AND {test}"""
_seen = lambda k: f"max(CASE WHEN src_tbl = '{k}' THEN 1 ELSE 0 END)"
query("abandoned", _PRODUCT_EVENT, _EVENT_SQL.format(flags=f"{_seen('checkout_started')} AS a, {_seen('order_completed')} AS z", kind="product_added", test="a = 1 AND z = 0"))(
    lambda w: web.abandoned_cart(w.web, w.products))
query("view_mix", _PRODUCT_EVENT, _EVENT_SQL.format(flags=f"{_seen('product_viewed')} AS a, {_seen('checkout_started')} AS z", kind="product_viewed", test="a = 1 AND z = 0"))(
    lambda w: web.product_view_mix(w.web, w.products))
query("checkout_loss", "session_id:i session_start_ts:t final_url:s last_checkout_step_viewed_ts:t last_checkout_step_completed_ts:t last_step_ts:t checkout_steps_completed:i", f"""
    SELECT session_id, session_start_ts, split_part(u.url, '?', 1) AS final_url, max(CASE WHEN src_tbl = 'checkout_step_viewed' THEN timestamp END) AS last_checkout_step_viewed_ts,
           max(CASE WHEN src_tbl = 'checkout_step_completed' THEN timestamp END) AS last_checkout_step_completed_ts, max(timestamp) AS last_step_ts,
           sum(CASE WHEN src_tbl = 'checkout_step_completed' THEN 1 ELSE 0 END) AS checkout_steps_completed
    FROM o_web w JOIN (SELECT session_id FROM o_web WHERE NOT is_internal GROUP BY 1 HAVING {_seen('checkout_started')} = 1 AND {_seen('order_completed')} = 0) USING (session_id)
    LEFT JOIN (SELECT session_id, arg_max(url, timestamp) AS url FROM o_web WHERE url IS NOT NULL GROUP BY 1) u USING (session_id)
    WHERE membership_state = 'new' GROUP BY ALL""")(lambda w: web.checkout_loss(w.web))
query("page_views", "member_id:s session_id:i product_id_master:s created_at:d own_referred:b page_views:i", """
    SELECT w.member_id, session_id, product_id_master, created_at, coalesce(referrer LIKE '%shop%', FALSE) AS own_referred, v.page_views FROM o_web w
    LEFT JOIN (SELECT member_id, count(*) AS page_views FROM o_web WHERE src_tbl = 'pages' AND member_id IS NOT NULL GROUP BY 1) v ON v.member_id = w.member_id""")(
    lambda w: web.page_views(w.web))
query("first_event_share", "week:d direct_to_product_pct:f", """
    SELECT date_trunc('week', session_start_ts) AS week, avg(CASE WHEN url ILIKE '%products/%' THEN 1 ELSE 0 END) AS direct_to_product_pct
    FROM (SELECT session_id, session_start_ts, first(url ORDER BY timestamp, id) AS url FROM o_web WHERE src_tbl = 'pages' GROUP BY 1, 2) GROUP BY 1""")(
    lambda w: web.first_page_share(w.web))
query("registry", "user_id:s member_id:s first_name:s last_initial:s hubspot_customer_id:s registry_creation_ts:t last_registry_activity_ts:t first_registry_view_ts:t "
      "last_registry_view_ts:t total_registry_views:i first_registry_checkout_ts:t last_registry_checkout_ts:t total_registry_checkouts:i order_completed:i", """
    WITH base AS (SELECT coalesce(w.registry_customer_id, w.user_id) AS user_id, w.member_id, m.first_name, m.last_initial, m.hubspot_customer_id,
            min(CASE WHEN src_tbl = 'add_to_registry_product_added' THEN timestamp END) AS registry_creation_ts, max(CASE WHEN src_tbl ILIKE '%registry%' THEN timestamp END) AS last_registry_activity_ts,
            min(CASE WHEN src_tbl = 'registry_registry_viewed' THEN timestamp END) AS first_registry_view_ts, max(CASE WHEN src_tbl = 'registry_registry_viewed' THEN timestamp END) AS last_registry_view_ts,
            sum(CASE WHEN src_tbl = 'registry_registry_viewed' THEN 1 END) AS total_registry_views, min(CASE WHEN src_tbl = 'registry_checkout_started' THEN timestamp END) AS first_registry_checkout_ts,
            max(CASE WHEN src_tbl = 'registry_checkout_started' THEN timestamp END) AS last_registry_checkout_ts, sum(CASE WHEN src_tbl = 'registry_checkout_started' THEN 1 END) AS total_registry_checkouts
        FROM o_web w LEFT JOIN o_members m ON m.member_id = w.member_id GROUP BY 1, 2, 3, 4, 5),
    later AS (SELECT user_id, max(CASE WHEN w.src_tbl = 'order_completed' THEN 1 ELSE 0 END) AS order_completed FROM base LEFT JOIN o_web w USING (user_id) WHERE first_registry_checkout_ts IS NOT NULL GROUP BY 1)
    SELECT base.*, later.order_completed FROM base LEFT JOIN later ON later.user_id = base.user_id WHERE registry_creation_ts IS NOT NULL""")(lambda w: w.registry)


def _go_live(w):
    changed = [("A", "https://www.example.com/Pages/home?x=1", "2001-05-10"), ("B", "http://shop.example.com/products/ITEM-25", "2001-05-15")]
    return w.spark.createDataFrame(changed, "product string, url string, live_date string")


query("pre_post", "go_live_date:d event_date:d period:s product:s page:s distinct_sessions:i distinct_members:i num_add_to_cart_events:i num_orders_completed:i", """
    WITH t AS (SELECT 'A' AS product, '/pages/home' AS page, DATE '2001-05-10' AS live UNION ALL SELECT 'B', '/products/item-25', DATE '2001-05-15'),
    e AS (SELECT w.*, coalesce(w.member_id, i.member_id, w.anonymous_id, w.user_id) AS who, lower(regexp_replace(regexp_replace(w.url, '^https?://[^/]*/', '/'), '\\?.*', '')) AS page
          FROM o_web w LEFT JOIN o_idmap i ON i.src = 'segment' AND i.src_id = w.anonymous_id),
    b AS (SELECT session_id, first(who ORDER BY timestamp, id) AS buyer FROM e WHERE src_tbl = 'order_completed' GROUP BY 1)
    SELECT live AS go_live_date, CAST(timestamp AS DATE) AS event_date, CASE WHEN CAST(timestamp AS DATE) < live THEN 'PRE' ELSE 'POST' END AS period, product, e.page,
           count(DISTINCT e.session_id) AS distinct_sessions, count(DISTINCT who) AS distinct_members,
           count(DISTINCT CASE WHEN src_tbl = 'product_added' THEN e.session_id END) AS num_add_to_cart_events, count(DISTINCT buyer) AS num_orders_completed
    FROM e JOIN t ON t.page = e.page AND e.timestamp BETWEEN live - INTERVAL 30 DAY AND live + INTERVAL 30 DAY LEFT JOIN b ON b.session_id = e.session_id GROUP BY ALL""")(
    lambda w: web.pre_post(w.web, _go_live(w), w.idmap))


# --- attribution -----------------------------------------------------------

def _purchases(w):
    """All purchases as conversions, 6-hour sessions as touches."""
    ev = w.table("events").select("user_id", "ts", "event_id", "event_type", "props")
    bought = ev.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("conversion_id"), F.col("user_id").alias("member_id"), F.col("ts").alias("order_ts"))
    k = F.expr(K)
    sessions = web.sessionize(ev, "user_id", "ts", "event_id", 21600).groupBy("session_id").agg(
        F.min("user_id").alias("member_id"), F.min("ts").alias("event_ts"), F.min_by(k, F.struct("ts", "event_id")).alias("k"))
    return bought, cut(sessions.select(
        F.col("session_id").alias("event_id"), "member_id", "event_ts", F.concat(F.lit("channel "), (F.col("k") % 6).cast("string")).alias("channel_id"),
        F.when(F.col("k") % 2 == 0, F.col("k").cast("string")).alias("campaign_id")))


_TOUCH_SQL = f"""
    touch AS (SELECT session_id AS event_id, min(user_id) AS member_id, min(ts) AS event_ts, first({K} ORDER BY ts, event_id) AS k
              FROM ({sessions_sql('events', 'user_id', 'ts', 'event_id', 21600)}) GROUP BY 1),
    conv AS (SELECT event_id AS conversion_id, user_id AS member_id, ts AS order_ts FROM events WHERE event_type = 'purchase'),
    win AS (SELECT c.conversion_id, c.member_id, c.order_ts, t.event_id, t.event_ts, 'channel ' || CAST(k % 6 AS VARCHAR) AS channel_id, CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) END AS campaign_id,
              row_number() OVER (PARTITION BY c.conversion_id ORDER BY t.event_ts, t.event_id) AS ra, row_number() OVER (PARTITION BY c.conversion_id ORDER BY t.event_ts DESC, t.event_id DESC) AS rd,
              count(*) OVER (PARTITION BY c.conversion_id) AS n
            FROM conv c LEFT JOIN touch t ON t.member_id = c.member_id AND t.event_ts <= c.order_ts + INTERVAL 24 HOUR AND t.event_ts >= c.order_ts - INTERVAL 4320 HOUR)"""
_WEIGHT_SQL = """conversion_id, member_id, order_ts, event_id, event_ts, coalesce(channel_id, 'direct') AS channel_id, coalesce(campaign_id, 'no campaign') AS campaign_id,
    CASE WHEN ra = 1 THEN 1.0 ELSE 0.0 END AS first_touch_weighting, CASE WHEN rd = 1 THEN 1.0 ELSE 0.0 END AS last_touch_weighting,
    CASE WHEN n = 1 THEN 1.0 WHEN n = 2 THEN 0.5 WHEN ra = 1 OR rd = 1 THEN 0.25 ELSE 0.5 / (n - 2.0) END AS multi_touch_weighting"""
query("attribution_multi_touch", "conversion_id:i member_id:i order_ts:t event_id:i event_ts:t channel_id:s campaign_id:s first_touch_weighting:f last_touch_weighting:f multi_touch_weighting:f",
      f"WITH {_TOUCH_SQL} SELECT {_WEIGHT_SQL} FROM win")(lambda w: attribution.attribute(*_purchases(w)))
query("attribution_by_channel", "channel_id:s conversions:i first_touch:f last_touch:f multi_touch:f", f"""
    WITH {_TOUCH_SQL} SELECT channel_id, count(DISTINCT conversion_id) AS conversions, sum(first_touch_weighting) AS first_touch, sum(last_touch_weighting) AS last_touch,
    sum(multi_touch_weighting) AS multi_touch FROM (SELECT {_WEIGHT_SQL} FROM win) GROUP BY 1""")(
    lambda w: attribution.credit(attribution.attribute(*_purchases(w))))
query("order_credit", "conversion_id:i member_id:i order_ts:t channel_id:s touches:i first_touch:f last_touch:f multi_touch:f", f"""
    WITH {_TOUCH_SQL} SELECT conversion_id, member_id, order_ts, channel_id, count(event_id) AS touches, sum(first_touch_weighting) AS first_touch, sum(last_touch_weighting) AS last_touch,
    sum(multi_touch_weighting) AS multi_touch FROM (SELECT {_WEIGHT_SQL} FROM win) GROUP BY 1, 2, 3, 4""")(
    lambda w: attribution.channel_credit(*_purchases(w)))
query("member_attribution", "member_id:s order_ts:d channel_id:s campaign_id:s first_touch_weighting:f last_touch_weighting:f multi_touch_weighting:f", "o_attributed")(lambda w: w.attribution)
_ORDER_TOUCH = """
    WITH touch AS (SELECT DISTINCT session_id, member_id, session_start_ts, session_channel_id, session_campaign_name FROM o_web WHERE member_id IS NOT NULL)
    SELECT o.order_id, o.member_id, o.order_ts, session_id AS event_id, session_start_ts AS event_ts, coalesce(session_channel_id, 'direct') AS channel_id, coalesce(session_campaign_name, 'no campaign') AS campaign_id,
        row_number() OVER (PARTITION BY o.order_id ORDER BY session_start_ts, session_id) AS ra, row_number() OVER (PARTITION BY o.order_id ORDER BY session_start_ts DESC, session_id DESC) AS rd,
        count(*) OVER (PARTITION BY o.order_id) AS n
    FROM o_orders o JOIN touch t ON t.member_id = o.member_id AND session_start_ts <= o.order_ts AND session_start_ts >= o.order_ts - INTERVAL 8760 HOUR"""
_WEIGHTS = "CASE WHEN ra = 1 THEN 1.0 ELSE 0.0 END AS first_touch_weighting, CASE WHEN rd = 1 THEN 1.0 ELSE 0.0 END AS last_touch_weighting, CASE WHEN n = 1 THEN 1.0 WHEN n = 2 THEN 0.5 WHEN ra = 1 OR rd = 1 THEN 0.25 ELSE 0.5 / (n - 2.0) END AS multi_touch_weighting"
query("order_attribution", "order_id:s member_id:s event_id:i order_ts:t event_ts:t channel_id:s campaign_id:s first_touch_weighting:f last_touch_weighting:f multi_touch_weighting:f",
      f"SELECT *, {_WEIGHTS} FROM ({_ORDER_TOUCH})")(lambda w: attribution.order_attribution(w.orders, w.web))
query("order_channel_credit", "order_id:s member_id:s order_ts:t channel_id:s touches:i first_touch:f last_touch:f multi_touch:f", f"""
    SELECT order_id, member_id, order_ts, channel_id, count(*) AS touches, sum(first_touch_weighting) AS first_touch, sum(last_touch_weighting) AS last_touch, sum(multi_touch_weighting) AS multi_touch
    FROM (SELECT *, {_WEIGHTS} FROM ({_ORDER_TOUCH})) GROUP BY 1, 2, 3, 4""")(lambda w: attribution.order_channel_credit(w.orders, w.web))

# --- identity --------------------------------------------------------------

query("identity_map", "src_id:s src:s email_key:s member_id:s", "o_idmap")(lambda w: w.idmap)
query("email_lookup", "email_key:s member_id:s", "o_emails")(lambda w: w.emails)
query("message_events", "event_id:s member_id:s email:s event_ts:t campaign_id:s campaign_name:s link_url:s", "o_messages")(
    lambda w: identity.message_events(w.source("messages"), w.emails))
for _kind in ("delivered", "opened"):
    query(f"message_{_kind}", "event_id:s member_id:s email:s event_ts:t campaign_id:s campaign_name:s", f"""
        SELECT m.id AS event_id, coalesce(e.member_id, md5(lower(trim(context_traits_email)))) AS member_id, context_traits_email AS email, timestamp AS event_ts, campaign_id, campaign_name
        FROM b_{_kind} m LEFT JOIN o_emails e ON e.email_key = md5(lower(trim(context_traits_email)))""")(lambda w, kind=_kind: identity.message_events(w.source(kind), w.emails))
query("capture_signups", "email:s user_id:s membership_start_dt:d", """
    WITH ident AS (SELECT email, user_id FROM b_events WHERE email IS NOT NULL)
    SELECT DISTINCT i.email, i.user_id, m.membership_start_dt FROM ident i JOIN (SELECT DISTINCT email FROM ident WHERE user_id IS NULL) USING (email)
    LEFT JOIN o_members m ON m.email = i.email WHERE i.user_id IS NOT NULL""")(lambda w: identity.capture_signups(w.source("events"), w.members))
query("customers_crm", "id:s email:s hubspot_id:s", """
    SELECT c.id, c.email, b.id AS hubspot_id FROM b_customers c LEFT JOIN (
        SELECT email, id FROM (SELECT email, id, row_number() OVER (PARTITION BY email ORDER BY updated_at DESC, id DESC) AS rn FROM b_contacts WHERE nullif(email, '') IS NOT NULL) WHERE rn = 1) b USING (email)""")(
    lambda w: identity.customers_crm(w.source("customers"), w.source("contacts")))

# --- commerce --------------------------------------------------------------

query("order_fact", "order_id:s member_id:s order_number:i order_type:s order_ts:t order_discounts:m order_gross:m order_tax:m order_total:m is_membership_order:b is_gift_card_order:b financial_status:s updated_ts:t n_codes:i", "o_orders")(
    lambda w: w.orders.withColumn("n_codes", F.size("discount_codes")))
query("json_first", "line_item_id:s order_id:s price:m quantity:i sku:s variant_id:s is_gift_card:b vendor:s total_discount:m", "o_lines")(lambda w: w.lines)
query("json_unnest", "refund_id:s member_id:s order_id:s created_ts:t processed_ts:t restock:b order_adjustments:m", "o_refunds")(lambda w: w.refunds)
query("refund_lines", "refund_id:s order_id:s refund_line_item_id:s line_item_id:s quantity:i restock_type:s subtotal:m total_tax:m total_discount:m requires_shipping:s price:m", "o_refund_lines")(lambda w: w.refund_lines)
query("order_codes", "order_id:s discount_code:s discount_amount:m discount_type:s", "o_codes")(lambda w: commerce.order_codes(w.source("orders")))
query("discount_codes", "order_id:s member_id:s discount_code:s discount_amount:m", "SELECT c.*, o.member_id FROM o_codes c JOIN o_orders o USING (order_id) WHERE discount_code IS NOT NULL")(
    lambda w: commerce.discount_codes(w.orders))
_LEDGER = "order_id:s member_id:s line_item_id:s transaction_ts:t order_number:i order_type:s sales_type:s sales_channel:s product_name:s sku:s quantity:i " + cols(" ".join(commerce.LEDGER_MONEY), "m")
query("ledger", _LEDGER, "o_ledger")(lambda w: w.ledger)
query("membership_orders", "email:s member_id:s created_at:t membership_product_name:s order_id:s product_id:s membership_price:m", "o_membership_orders")(lambda w: w.membership_orders)
query("gift_only_orders", "order_id:s", "o_gift_orders")(lambda w: commerce.gift_card_orders(w.source("line_items"), w.source("products")))
query("special_members", "member_id:s", "o_special")(lambda w: w.special)
query("discount_offsets", "member_id:s start_date:d end_date:d discount_mrr_offset:m", "o_offsets")(lambda w: w.offsets)
query("sku_price_min", "sku:s avg_price:m", "o_prices")(lambda w: w.prices)
_BASKET = "member_id:s {0} dense_rank:i basket_ct:i basket_dollars:m membership_dollars:m has_flagship:i basket_products:s total_discounts:m net_basket_size:m basket_bin:s"
query("baskets_all", _BASKET.format("order_ts:t"), "o_order_baskets")(lambda w: w.order_baskets)
for _name, _n in (("first_basket", 1), ("second_basket", 2)):
    query(_name, _BASKET.format("order_ts:t"), f"SELECT * FROM o_order_baskets WHERE dense_rank = {_n}")(lambda w, n=_n: commerce.nth_basket(w.order_baskets, n))
query("rental_baskets", _BASKET.format("delivery_date:d"), "o_rental_baskets")(lambda w: w.rental_baskets)
query("member_sales_month", "member_id:s short_name:s ops_location:s membership_type:s member_status:s membership_start_dt:d membership_end_dt:d month:d net_sales:m", """
    SELECT l.member_id, m.first_name || ' ' || m.last_initial AS short_name, m.ops_location, m.membership_type, m.member_status, m.membership_start_dt, m.membership_end_dt,
           date_trunc('month', transaction_ts) AS month, sum(net_sales) AS net_sales FROM o_ledger l LEFT JOIN o_members m ON m.member_id = l.member_id GROUP BY ALL""")(lambda w: w.member_sales)
_REPEAT = """r AS (SELECT l.*, o.source_name, o.customer_id, row_number() OVER (PARTITION BY o.customer_id, l.product_id ORDER BY o.created_at, l.order_id, l.id) AS rn
                   FROM b_line_items l JOIN o_heads o ON o.id = l.order_id)"""
query("repeat_lines", "id:s price:m quantity:i title:s total_discount:m variant_id:s name:s product_id:s order_id:s",
      f"WITH {_REPEAT} SELECT * FROM r WHERE rn > 1 AND source_name = 'subscription_contract'")(lambda w: commerce.renewal_lines(w.source("line_items"), w.source("orders")))
query("fulfilment_lines", "id:s price:m quantity:i title:s total_discount:m variant_id:s name:s product_id:s order_id:s raw_order_line_id:s multiple_qty_flag:b unbundled_flag:b", f"""
    WITH {_REPEAT}, u AS (SELECT r.*, unnest(range(1, greatest(quantity, 1) + 1)) AS n FROM r WHERE rn = 1 OR source_name <> 'subscription_contract'),
    f AS (SELECT CASE WHEN n > 1 THEN CAST(n AS VARCHAR) || '-' || id ELSE id END AS uid, u.* EXCLUDE (id, product_id), id AS raw_order_line_id, u.product_id, b.extra_name, b.extra_product_id
          FROM u LEFT JOIN b_bundles b ON b.product_id = u.product_id)
    SELECT uid AS id, price, 1 AS quantity, title, total_discount, variant_id, name, product_id, order_id, raw_order_line_id, quantity > 1 AS multiple_qty_flag, extra_product_id IS NOT NULL AS unbundled_flag FROM f
    UNION ALL SELECT '9.' || uid, 0, 1, title, total_discount, variant_id, extra_name, extra_product_id, order_id, raw_order_line_id, quantity > 1, TRUE FROM f WHERE extra_product_id IS NOT NULL""")(
    lambda w: commerce.fulfilment_lines(w.source("line_items"), w.source("orders"), w.source("bundles")))
_ADDRESS = """a AS (SELECT id AS order_id, """ + ", ".join(f"json_extract_string(shipping_address, '$.{f}') AS {f}" for f in commerce.ADDRESS_FIELDS) + """ FROM b_orders),
    k AS (SELECT *, CASE WHEN nullif(address1, '') IS NOT NULL THEN md5(lower(trim(latitude)) || lower(trim(longitude)) || lower(regexp_replace(address1, '[^0-9a-zA-Z]', '', 'g'))
                 || lower(regexp_replace(address2, '[^0-9a-zA-Z]', '', 'g'))) END AS address_id FROM a)"""
query("address_key", "order_id:s address_id:s " + cols(" ".join(commerce.ADDRESS_FIELDS), "s"), f"WITH {_ADDRESS} SELECT * FROM k")(lambda w: w.addresses)
query("latest_address", "id:s name:s address_line_1:s address_line_2:s city:s state:s lat:s long:s", f"""
    WITH {_ADDRESS} SELECT address_id AS id, name, address1 AS address_line_1, address2 AS address_line_2, city, province AS state, latitude AS lat, longitude AS long
    FROM (SELECT *, row_number() OVER (PARTITION BY address_id ORDER BY order_id DESC) AS rn FROM k WHERE address_id IS NOT NULL) WHERE rn = 1""")(lambda w: commerce.shipping_addresses(w.addresses))
query("first_time_orders", "id:s order_number:i order_date:d customer_id:s created_at:s updated_at:s subtotal_price:s total_discounts:s financial_status:s source_name:s raw_address_id:s raw_inventory_location:i", f"""
    WITH {_REPEAT}, {_ADDRESS} SELECT o.id, o.order_number, o.created_at AS order_date, o.customer_id, strftime(o.created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at, strftime(o.updated_at, '%Y-%m-%dT%H:%M:%SZ') AS updated_at,
        o.subtotal_price, o.total_discounts, o.financial_status, o.source_name, k.address_id AS raw_address_id, CASE k.province WHEN 'Province 1' THEN 1 WHEN 'Province 2' THEN 2 WHEN 'Province 3' THEN 2 END AS raw_inventory_location
    FROM o_heads o LEFT JOIN k ON k.order_id = o.id WHERE o.id IN (SELECT order_id FROM r WHERE rn = 1 OR source_name <> 'subscription_contract')""")(
    lambda w: commerce.fulfilment_orders(w.source("line_items"), w.source("orders"), w.addresses, SETTINGS.provinces))
query("registry_pairs", "line_item_id:s order_id:s price:m product_id:s variant_id:s recipient_shopify_id:s customer_shopify_id:s customer_member_id:s customer_email:s recipient_member_id:s recipient_email:s", """
    SELECT l.id AS line_item_id, l.order_id, l.price, l.product_id, l.variant_id, substring(l.vendor, 2) AS recipient_shopify_id, o.customer_id AS customer_shopify_id, md5(lower(trim(c.email))) AS customer_member_id,
           c.email AS customer_email, md5(lower(trim(g.email))) AS recipient_member_id, g.email AS recipient_email
    FROM b_line_items l JOIN o_heads o ON o.id = l.order_id LEFT JOIN b_customers c ON c.id = o.customer_id LEFT JOIN b_customers g ON g.id = substring(l.vendor, 2) WHERE l.fulfillment_service = 'registry'""")(
    lambda w: web.registry_pairs(w.source("line_items"), w.source("orders"), w.source("customers")))
query("unit_expansion", "l_orderkey:i units:i last_unit:i unit_sum:i", """
    SELECT l_orderkey, count(*) AS units, max(unit) AS last_unit, sum(unit) AS unit_sum FROM (SELECT l_orderkey, unnest(range(1, CAST(l_quantity AS INT) + 1)) AS unit FROM lineitem) GROUP BY 1""")(
    lambda w: calendar.expand_units(w.table("lineitem").select("l_orderkey", "l_quantity"), "l_quantity").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("units"), F.max("unit").alias("last_unit"), F.sum("unit").alias("unit_sum")))

# --- rentals ---------------------------------------------------------------

_RENTAL = "bin:s member_id:s line_item_id:s sku:s order_id:s delivery_date:d pick_up_date:d avg_price:m ops_location:s"
query("rental_fact", _RENTAL, "o_rentals")(lambda w: w.rentals)
query("subscriptions", "member_id:s sku:s net_price:m quantity:i start_dt:d end_dt:d", "SELECT member_id, sku, avg_price AS net_price, 1 AS quantity, delivery_date AS start_dt, pick_up_date AS end_dt FROM o_rentals")(lambda w: w.subscriptions)
query("rental_sheets", "member_id:s bin:s sku:s order_id:s delivery_date:d pick_up_date:d avg_price:m ops_location:s", """
    WITH paid AS (SELECT member_id, sku, price, row_number() OVER (PARTITION BY member_id, sku ORDER BY order_ts, line_item_id) AS rn FROM o_orders JOIN o_lines USING (order_id) WHERE member_id IS NOT NULL)
    SELECT i.member_id, r.bin, r.item_id AS sku, o.id AS order_id, r.delivery_date, nullif(r.pick_up_date, '') AS pick_up_date, coalesce(paid.price, s.avg_price) AS avg_price,
           CASE r.l_linestatus WHEN 'F' THEN 'SF' ELSE 'NYC' END AS ops_location
    FROM b_sheets r LEFT JOIN o_idmap i ON i.src = 'hubspot' AND i.src_id = r.hubspot_customer_id LEFT JOIN b_orders o ON CAST(o.order_number AS VARCHAR) = r.shopify_order_id
    LEFT JOIN o_prices s ON s.sku = r.item_id LEFT JOIN paid ON paid.member_id = i.member_id AND paid.sku = s.sku AND paid.rn = 1""")(lambda w: rentals.fact_rental_sheets(
    {"SF": w.source("sheets").filter("l_linestatus = 'F'"), "NYC": w.source("sheets").filter("l_linestatus = 'O'")}, w.idmap, w.orders, w.lines, w.source("orders"), w.prices))
query("item_dim", cols("item_name store purchase_method bin_status location tracking_info", "s") + " " + cols("estimated_actual_arrival scrap_date", "d") + " " + cols("retail_price actual_tax_cost actual_shipping_cost", "m") + " bin:s sku:s category:s purchase_date:d actual_purchase_price:m actual_total_cost:m assembly_time:f received:b asset_sold:b asset_sale_date:d asset_sale_amount:m asset_scrapped:b ops_location:s", "o_items")(lambda w: w.items)
query("daily_revenue", "date:d kind:s n:i revenue:m", "SELECT date, CASE WHEN sku IS NULL THEN 'plan' ELSE 'rental' END AS kind, count(*) AS n, sum(revenue) AS revenue FROM o_revenue GROUP BY 1, 2")(
    lambda w: w.revenue.groupBy("date", F.when(F.col("sku").isNull(), "plan").otherwise("rental").alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.sum("revenue").alias("revenue")))
query("daily_revenue_totals", "date:d revenue:m", "SELECT date, coalesce(sum(revenue), 0) AS revenue FROM o_days LEFT JOIN o_revenue USING (date) GROUP BY 1")(
    lambda w: rentals.daily_revenue_totals(w.subscriptions, w.memberships, SETTINGS.as_of, SETTINGS.first_day))
query("depreciation", "date:d n:i depreciation_expense:m depreciated_amount:m remaining_value:m", f"""
    WITH b AS (SELECT i.bin, i.actual_purchase_price AS amt, CAST(i.actual_purchase_price / 720 AS DECIMAL(24,6)) AS daily, min(r.delivery_date) AS first_d FROM o_items i JOIN o_rentals r USING (bin) GROUP BY 1, 2, 3),
    x AS (SELECT d.date, b.*, row_number() OVER (PARTITION BY b.bin ORDER BY d.date) AS n FROM o_days d JOIN b ON d.date >= first_d AND d.date < first_d + INTERVAL 720 DAY WHERE first_d <= {AS_OF})
    SELECT date, count(*) AS n, sum(daily) AS depreciation_expense, sum(daily * n) AS depreciated_amount, sum(amt - daily * n) AS remaining_value FROM x GROUP BY 1""")(
    lambda w: w.depreciation.groupBy("date").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("depreciation_expense", "depreciated_amount", "remaining_value")]))
query("depreciation_refresh", "date:d n:i depreciation_expense:m depreciated_amount:m remaining_value:m", CATALOG["depreciation"].sql)(lambda w: _refreshed(w).groupBy("date").agg(
    F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in ("depreciation_expense", "depreciated_amount", "remaining_value")]))
query("depreciation_by_asset", "bin:s n:i first_date:d last_date:d depreciation_expense:m depreciated_amount:m remaining_value:m", CATALOG["depreciation"].sql.replace(
    "SELECT date, count(*) AS n", "SELECT bin, min(date) AS first_date, max(date) AS last_date, count(*) AS n"))(lambda w: w.depreciation.groupBy("bin").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(c) for c in ("depreciation_expense", "depreciated_amount", "remaining_value")]))
query("revenue_by_member", "member_id:s sku:s membership_type:s n:i first_date:d last_date:d revenue:m", """
    SELECT member_id, sku, membership_type, count(*) AS n, min(date) AS first_date, max(date) AS last_date, sum(revenue) AS revenue FROM o_revenue GROUP BY 1, 2, 3""")(
    lambda w: w.revenue.groupBy("member_id", "sku", "membership_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.sum("revenue").alias("revenue")))
query("visitors", "day:d kind:s visitors:i buyers:i", """
    SELECT CAST(ts AS DATE) AS day, event_type AS kind, count(DISTINCT user_id) AS visitors, count(DISTINCT CASE WHEN event_type = 'purchase' THEN user_id END) AS buyers
    FROM events GROUP BY 1, 2""")(lambda w: _visitors(w))
query("sku_agg", "sku:s product_name:s inventory_count:i active_count:i rental_count:i avg_completed_duration:f avg_active_duration:f dwell_time:f total_revenue:m total_members:i current_mrr:m total_inventory_days:i "
      "total_rental_days:i non_dwell_inventory_days:i", "o_sku_agg")(lambda w: w.sku_agg)
query("duration_median", "ops_location:s min_duration:i max_duration:i avg_duration:f median_duration:f observations:i", """
    SELECT ops_location, min(n) AS min_duration, max(n) AS max_duration, avg(n) AS avg_duration, median(n) AS median_duration, count(*) AS observations
    FROM (SELECT ops_location, pick_up_date - delivery_date AS n FROM o_rentals WHERE pick_up_date IS NOT NULL AND delivery_date IS NOT NULL) GROUP BY 1""")(lambda w: rentals.duration_stats(w.rentals, by=["ops_location"]))
query("duration_by_sku", "sku:s min_duration:i max_duration:i avg_duration:f median_duration:f observations:i", CATALOG["duration_median"].sql.replace("ops_location", "sku"))(lambda w: rentals.duration_stats(w.rentals, by=["sku"]))
query("open_rentals", "delivery_date:d n:i days_open:i", f"SELECT delivery_date, count(*) AS n, date_diff('day', delivery_date, {AS_OF}) AS days_open FROM o_rentals WHERE pick_up_date IS NULL GROUP BY 1")(
    lambda w: rentals.open_rentals(w.rentals, SETTINGS.as_of))
query("scheduled_items", "scheduled_items:i customers_with_scheduled_items:i scheduled_mrr:m", f"""
    SELECT count(*) AS scheduled_items, count(DISTINCT member_id) AS customers_with_scheduled_items, sum(s.avg_price) AS scheduled_mrr FROM o_rentals r LEFT JOIN o_prices s ON s.sku = r.sku WHERE delivery_date > {AS_OF}""")(
    lambda w: rentals.scheduled_items(w.rentals, w.prices, SETTINGS.as_of))

# --- lifecycle -------------------------------------------------------------

query("payment_agg", "member_id:s " + cols("min_month_payment_ts max_month_payment_ts min_annual_payment_ts max_annual_payment_ts min_per_item_payment_ts max_per_item_payment_ts max_product_payment_ts", "t") + " active_sku_ct:i", "o_payment_agg")(
    lambda w: lifecycle.payment_agg(w.ledger, SETTINGS.as_of))
query("full_outer_stats", "member_id:s first_membership_purchase_ts:t last_membership_payment_ts:t last_product_payment_ts:t ct_active_product_payments:i ct_purchased_skus:i is_ever_purchased_flagship:i avg_purchased_gift_card:f "
      "avg_purchased_registry_product:f is_influencer:i ct_active_products:i ct_items_with_scheduled_delivery:i ct_items_with_scheduled_pickup:i ct_skus_delivered:i is_only_flagship_rented:i first_delivery_date:d is_only_flagship_paid:i", "o_inputs")(
    lambda w: w.lifecycle_inputs)
_MEMBER = ("member_id:s hubspot_customer_id:s email:s last_initial:s membership_start_dt:d membership_end_dt:d membership_type:s youngest_child_dob:d number_of_children:i is_shared_offer:b shared_offer_ts:t first_item_order_dt:d "
           "first_delivery_dt:d last_pick_up_dt:d ops_location:s first_name:s last_name:s monthly_membership_end_date:d member_status:s member_sub_status:s member_status_detail:s " + cols("first_membership_purchase_ts last_membership_payment_ts last_product_payment_ts contact_created_ts", "t") + " "
           + cols("ct_active_product_payments ct_purchased_skus ct_active_products ct_items_with_scheduled_delivery ct_items_with_scheduled_pickup ct_skus_delivered is_only_flagship_rented status_case is_ever_purchased_flagship is_only_flagship_paid", "i")
           + " " + cols("first_delivery_date child_1_dob child_2_dob child_3_dob", "d") + " " + cols("hs_analytics_source hs_analytics_source_data expecting_at_sign_up city address zip state reason_for_canceling", "s"))
query("member_dim", _MEMBER, "o_members")(lambda w: w.members)
query("membership_type", "membership_type:s members:i", "SELECT membership_type, count(*) AS members FROM o_members GROUP BY 1")(lambda w: w.members.groupBy("membership_type").agg(F.count(F.lit(1)).alias("members")))
query("status_rules", "member_id:s status_case:i member_status:s member_sub_status:s member_status_detail:s", "o_members")(lambda w: w.members)
query("membership_dim", "member_id:s start_dt:d end_dt:d membership_type:s status:s price:m", "o_memberships")(lambda w: w.memberships)
query("customer_feed", "member_id:s email:s next_delivery_date:d most_recent_delivery_date:d status:s membership_type:s membership_start_date:d membership_end_date:d inactive_date:d registry_user:i", f"""
    WITH owner AS (SELECT DISTINCT i.member_id FROM (SELECT coalesce(registry_customer_id, user_id) AS user_id, member_id FROM o_web WHERE src_tbl = 'add_to_registry_product_added') r JOIN o_idmap i ON i.src = 'shopify' AND i.src_id = r.user_id),
    trip AS (SELECT member_id, min(CASE WHEN delivery_date > {AS_OF} THEN delivery_date END) AS nx, max(CASE WHEN delivery_date <= {AS_OF} THEN delivery_date END) AS lt, max(pick_up_date) AS up FROM o_rentals GROUP BY 1)
    SELECT m.member_id, m.email, nx AS next_delivery_date, lt AS most_recent_delivery_date, m.member_status AS status, m.membership_type, m.membership_start_dt AS membership_start_date, m.membership_end_dt AS membership_end_date,
           CASE WHEN m.member_status = 'Churned' THEN up END AS inactive_date, CASE WHEN owner.member_id IS NOT NULL THEN 1 ELSE 0 END AS registry_user
    FROM o_members m LEFT JOIN trip USING (member_id) LEFT JOIN owner USING (member_id) WHERE m.membership_start_dt <= {AS_OF}""")(lambda w: w.customer_feed)
_never = "coalesce({0}, TIMESTAMP '9999-12-31')"
_pick = lambda c, n: f"CASE WHEN {_never.format('o1.order_ts')} < {_never.format('CAST(r1.delivery_date AS TIMESTAMP)')} THEN o{n}.{c} ELSE r{n}.{c} END"
query("member_agg", "member_id:s membership_start_dt:d membership_type:s ops_location:s is_flagship_customer:b initial_basket_ct:i initial_basket_products:s initial_basket_product_dollars_gross:m initial_membership_total:m "
      "initial_basket_discounts:m second_basket_ct:i second_basket_products:s second_basket_product_dollars_gross:m first_order_flagship_only:i all_time_rented_products:i active_products:i current_mrr:m visit_count:i "
      "has_flagship_in_home:i has_other_in_home:i flagship_days:i member_discount_codes:s total_revenue:m days_to_second_order:i first_touch_channel:s first_touch_ts:t first_product_viewed:s first_url_viewed:s "
      "num_sessions_prior_to_conversion:i is_direct_to_flagship:i saw_flagship:i num_unique_products_viewed_prior_to_conversion:i channel_source_id:s membership_end_dt:d youngest_child_dob:d number_of_children:i expecting_at_sign_up:s "
      + cols("second_membership_total second_basket_discounts", "m") + " " + cols(" ".join(f"{x}_basket_total_dollars_{y}" for x in ("initial", "second") for y in ("gross", "net")), "m"), "SELECT *, " + ", ".join(
          f"{x}_basket_product_dollars_gross + {x}_membership_total AS {x}_basket_total_dollars_gross, {x}_basket_product_dollars_gross + {x}_membership_total - {x}_basket_discounts AS {x}_basket_total_dollars_net" for x in ("initial", "second")) + f""" FROM (
    WITH home AS (SELECT *, delivery_date <= {AS_OF} AND coalesce(pick_up_date, DATE '9999-12-31') >= {AS_OF} AS at_home FROM o_rentals),
    rent AS (SELECT member_id, count(*) AS all_time_rented_products, sum(CASE WHEN at_home THEN 1 ELSE 0 END) AS active_products, sum(CASE WHEN at_home THEN avg_price ELSE 0 END) AS current_mrr,
        count(DISTINCT delivery_date) AS visit_count, max(CASE WHEN sku = '42' AND at_home THEN 1 ELSE 0 END) AS has_flagship_in_home, max(CASE WHEN sku <> '42' AND at_home THEN 1 ELSE 0 END) AS has_other_in_home,
        sum(CASE WHEN sku = '42' AND delivery_date <= {AS_OF} THEN coalesce(pick_up_date, {AS_OF}) - delivery_date END) AS flagship_days FROM home GROUP BY 1),
    codes AS (SELECT member_id, string_agg(DISTINCT discount_code, ',' ORDER BY discount_code) AS member_discount_codes FROM o_codes JOIN o_orders USING (order_id) GROUP BY 1),
    cltv AS (SELECT member_id, sum(net_sales) AS total_revenue FROM o_ledger GROUP BY 1),
    gap AS (SELECT member_id, nxt - delivery_date AS days_to_second_order FROM (SELECT member_id, delivery_date, lead(delivery_date) OVER w AS nxt, row_number() OVER w AS rn
              FROM (SELECT DISTINCT member_id, delivery_date FROM o_rentals WHERE delivery_date IS NOT NULL) WINDOW w AS (PARTITION BY member_id ORDER BY delivery_date)) WHERE rn = 1),
    page AS (SELECT w.member_id, session_id, min(session_start_ts) AS st, first(url ORDER BY timestamp, id) FILTER (WHERE src_tbl = 'pages') AS u, max(CASE WHEN src_tbl = 'product_viewed' AND product_id = '42' THEN 1 ELSE 0 END) AS saw
             FROM o_web w GROUP BY 1, 2),
    seen AS (SELECT member_id, max(CASE WHEN u ILIKE '%shop.example.com/products/%' THEN 1 ELSE 0 END) AS is_direct_to_flagship, first(saw ORDER BY st, session_id) AS saw_flagship FROM page GROUP BY 1),
    touch AS (SELECT w.member_id, first(user_first_session_channel_id ORDER BY timestamp, id) AS channel, min(timestamp) AS first_touch_ts, first(product_id ORDER BY timestamp, id) FILTER (WHERE product_id IS NOT NULL) AS first_product_viewed,
        first(url ORDER BY timestamp, id) AS first_url_viewed, count(DISTINCT CASE WHEN timestamp < m.membership_start_dt THEN session_id END) AS num_sessions_prior_to_conversion,
        count(DISTINCT CASE WHEN timestamp < m.membership_start_dt AND src_tbl = 'product_viewed' THEN product_id END) AS num_unique_products_viewed_prior_to_conversion
        FROM o_web w JOIN o_members m ON m.member_id = w.member_id GROUP BY 1)
    SELECT m.member_id, m.membership_start_dt, m.membership_type, m.ops_location, m.membership_end_dt, m.youngest_child_dob, m.number_of_children, m.expecting_at_sign_up, touch.channel AS channel_source_id,
        touch.num_unique_products_viewed_prior_to_conversion, CASE WHEN o1.member_id IS NOT NULL OR r1.member_id IS NOT NULL THEN coalesce({_pick('membership_dollars', 2)}, 0) END AS second_membership_total,
        CASE WHEN o1.member_id IS NOT NULL OR r1.member_id IS NOT NULL THEN coalesce({_pick('total_discounts', 2)}, 0) END AS second_basket_discounts,
        CASE WHEN o1.member_id IS NOT NULL OR r1.member_id IS NOT NULL THEN coalesce({_pick('has_flagship', 1)} = 1, FALSE) END AS is_flagship_customer, {_pick('basket_ct', 1)} AS initial_basket_ct,
        {_pick('basket_products', 1)} AS initial_basket_products, CASE WHEN o1.member_id IS NOT NULL OR r1.member_id IS NOT NULL THEN coalesce({_pick('basket_dollars', 1)}, 0) END AS initial_basket_product_dollars_gross,
        CASE WHEN o1.member_id IS NOT NULL OR r1.member_id IS NOT NULL THEN coalesce({_pick('membership_dollars', 1)}, 0) END AS initial_membership_total,
        CASE WHEN o1.member_id IS NOT NULL OR r1.member_id IS NOT NULL THEN coalesce({_pick('total_discounts', 1)}, 0) END AS initial_basket_discounts, {_pick('basket_ct', 2)} AS second_basket_ct,
        {_pick('basket_products', 2)} AS second_basket_products, CASE WHEN o1.member_id IS NOT NULL OR r1.member_id IS NOT NULL THEN coalesce({_pick('basket_dollars', 2)}, 0) END AS second_basket_product_dollars_gross,
        CASE WHEN o1.member_id IS NOT NULL OR r1.member_id IS NOT NULL THEN CASE WHEN {_pick('basket_ct', 1)} = 1 AND {_pick('has_flagship', 1)} = 1 THEN 1 ELSE 0 END END AS first_order_flagship_only,
        rent.* EXCLUDE (member_id), codes.member_discount_codes, cltv.total_revenue, gap.days_to_second_order, ch.channel_name AS first_touch_channel, touch.first_touch_ts, touch.first_product_viewed, touch.first_url_viewed,
        touch.num_sessions_prior_to_conversion, CASE WHEN touch.member_id IS NOT NULL THEN seen.is_direct_to_flagship END AS is_direct_to_flagship, CASE WHEN touch.member_id IS NOT NULL THEN seen.saw_flagship END AS saw_flagship
    FROM o_members m LEFT JOIN o_order_baskets o1 ON o1.member_id = m.member_id AND o1.dense_rank = 1 LEFT JOIN o_order_baskets o2 ON o2.member_id = m.member_id AND o2.dense_rank = 2
    LEFT JOIN o_rental_baskets r1 ON r1.member_id = m.member_id AND r1.dense_rank = 1 LEFT JOIN o_rental_baskets r2 ON r2.member_id = m.member_id AND r2.dense_rank = 2
    LEFT JOIN rent ON rent.member_id = m.member_id LEFT JOIN codes ON codes.member_id = m.member_id LEFT JOIN cltv ON cltv.member_id = m.member_id LEFT JOIN gap ON gap.member_id = m.member_id
    LEFT JOIN touch ON touch.member_id = m.member_id LEFT JOIN seen ON seen.member_id = m.member_id LEFT JOIN b_channels ch ON ch.channel_source_id = touch.channel
    WHERE m.membership_start_dt <= {AS_OF})""")(lambda w: w.member_agg)
query("churn_listing", "member_id:s first_name:s last_initial:s first_touch_channel:s membership_start_dt:d membership_end_dt:d first_delivery_dt:d last_pick_up_dt:d ordered_mrr:m ordered_product_count:i products:s", f"""
    WITH b AS (SELECT o.member_id, l.sku, l.price, p.product_name FROM o_lines l JOIN o_products p USING (sku) JOIN o_orders o USING (order_id)
               WHERE product_name NOT ILIKE '%membership%' AND product_name NOT ILIKE '%plan%' AND order_type <> 'subscription_contract'),
    s AS (SELECT member_id, sum(price) AS ordered_mrr, count(DISTINCT sku) AS ordered_product_count, string_agg(product_name, ', ' ORDER BY product_name) AS products FROM b GROUP BY 1)
    SELECT m.member_id, m.first_name, m.last_initial, a.channel_id AS first_touch_channel, m.membership_start_dt, c.monthly_membership_end_date AS membership_end_dt,
           m.first_delivery_dt, m.last_pick_up_dt, s.ordered_mrr, s.ordered_product_count, s.products
    FROM b_contacts c JOIN o_members m ON m.hubspot_customer_id = c.id LEFT JOIN s ON s.member_id = m.member_id LEFT JOIN o_attributed a ON a.member_id = m.member_id AND a.first_touch_weighting = 1 WHERE c.monthly_membership_end_date IS NOT NULL""")(
    lambda w: lifecycle.churn_listing(w.source("contacts"), w.members, w.attribution, w.orders, w.lines, w.products))

# --- cohorts and KPIs ------------------------------------------------------

query("cohort_month", "month:d membership_type:s first_delivery_month:d initial_basket_has_flagship:s n:i members:i item_mrr:m membership_mrr:f discount_offset:m net_mrr:f", f"""
    WITH mon AS (SELECT CAST(unnest(generate_series({FIRST}, {AS_OF}, INTERVAL 1 MONTH)) AS DATE) AS month),
    r AS (SELECT r.*, m.membership_type, min(delivery_date) OVER (PARTITION BY r.member_id) AS first_d FROM o_rentals r JOIN o_members m ON m.member_id = r.member_id),
    x AS (SELECT mon.month, r.*, row_number() OVER (PARTITION BY r.member_id, mon.month ORDER BY sku, line_item_id) AS rn FROM r JOIN mon ON r.delivery_date < mon.month + INTERVAL 1 MONTH AND coalesce(r.pick_up_date, DATE '9999-12-31') >= mon.month),
    off AS (SELECT o.member_id, mon.month, sum(discount_mrr_offset) AS v FROM o_offsets o JOIN mon ON o.start_date < mon.month AND o.end_date >= mon.month GROUP BY 1, 2),
    y AS (SELECT x.*, CAST(CASE WHEN rn = 1 THEN CASE membership_type WHEN 'annual' THEN 149.0 / 12 WHEN 'monthly' THEN 18 ELSE 0 END ELSE 0 END AS DECIMAL(24,6)) AS plan, CASE WHEN rn = 1 THEN coalesce(off.v, 0) ELSE 0 END AS off,
                 CASE WHEN b.has_flagship = 1 THEN 'YES' ELSE 'NO' END AS fl
          FROM x LEFT JOIN off ON off.member_id = x.member_id AND off.month = x.month LEFT JOIN o_rental_baskets b ON b.member_id = x.member_id AND b.dense_rank = 1)
    SELECT month, membership_type, date_trunc('month', first_d) AS first_delivery_month, fl AS initial_basket_has_flagship, count(*) AS n, count(DISTINCT member_id) AS members, sum(avg_price) AS item_mrr, sum(plan) AS membership_mrr,
           sum(off) AS discount_offset, sum(avg_price + plan + off) AS net_mrr FROM y GROUP BY ALL""")(
    lambda w: w.cohorts.groupBy("month", "membership_type", "first_delivery_month", "initial_basket_has_flagship").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("member_id").alias("members"), *[F.sum(c).alias(c) for c in ("item_mrr", "membership_mrr", "discount_offset", "net_mrr")]))

_TYPE_TEST = {"": "membership_type IN ('annual', 'monthly')", "_annual": "membership_type = 'annual'", "_monthly": "membership_type = 'monthly'", "_per_item": "membership_type = 'per-item'"}
_REACHED = {"new": ("membership_start_dt", "TRUE"), "scheduled": ("first_item_order_dt", "member_status <> 'lead' AND membership_start_dt <= first_item_order_dt"),
            "active": ("first_delivery_dt", "member_status <> 'lead' AND first_item_order_dt <= first_delivery_dt"),
            "inactive": ("last_pick_up_dt", "member_status <> 'lead' AND first_delivery_dt <= last_pick_up_dt"), "lapsed": ("membership_end_dt", "TRUE")}
_sums = lambda s: ", ".join(f"sum(CASE WHEN {t} THEN 1 ELSE 0 END) AS {s}{x}_members" for x, t in _TYPE_TEST.items())
_KPI_SQL = "WITH " + ", ".join(f"k_{s} AS (SELECT {d} AS date, {_sums(s)} FROM o_members WHERE {d} IS NOT NULL AND {t} GROUP BY 1)" for s, (d, t) in _REACHED.items()) + ", k_lab AS (SELECT membership_end_dt AS date, " + ", ".join(
    f"sum(CASE WHEN {t} AND member_status = '{label}' THEN 1 ELSE 0 END) AS lapsed_{s}{x}_members" for s, label in SETTINGS.lapsed_labels.items() for x, t in _TYPE_TEST.items()) + """
    FROM o_members WHERE membership_end_dt IS NOT NULL GROUP BY 1), """ + ", ".join(
    f"k_{n} AS (SELECT {d} AS date, " + ", ".join(f"sum(CASE WHEN {t} THEN 1 ELSE 0 END) AS {n}{x}_items, sum({'avg_price' if x == '' else f'CASE WHEN {t} THEN avg_price END'}) AS {n}{x}_mrr" for x, t in _TYPE_TEST.items())
    + f" FROM o_rentals LEFT JOIN o_members USING (member_id) WHERE {d} IS NOT NULL GROUP BY 1)" for n, d in (("delivered", "delivery_date"), ("picked_up", "pick_up_date"))) + ", " + ", ".join(
    f"k_{n} AS (SELECT {d} AS date, " + ", ".join(f"sum({'discount_mrr_offset' if x == '' else f'CASE WHEN {t} THEN discount_mrr_offset END'}) AS {n}{x}" for x, t in _TYPE_TEST.items())
    + f" FROM o_offsets LEFT JOIN o_members USING (member_id) GROUP BY 1)" for n, d in (("off_start", "start_date"), ("off_end", "end_date"))) + ", k_day AS (SELECT o_days.date, " + ", ".join(
    [f"coalesce({s}{x}_members, 0) AS {s}{x}_members" for s in _REACHED for x in _TYPE_TEST] + [f"coalesce(lapsed_{s}{x}_members, 0) AS lapsed_{s}{x}_members" for s in SETTINGS.lapsed_labels for x in _TYPE_TEST]
    + [f"coalesce({n}{x}_{k}, 0) AS {n}{x}_{k}" for n in ("delivered", "picked_up") for x in _TYPE_TEST for k in ("items", "mrr")]
    + [f"coalesce(off_start{x}, 0) - coalesce(off_end{x}, 0) AS discount_mrr_offset{x}" for x in _TYPE_TEST]) + " FROM o_days " + " ".join(
    f"LEFT JOIN k_{n} USING (date)" for n in (*_REACHED, "lab", "delivered", "picked_up", "off_start", "off_end")) + "), k_cum AS (SELECT *, " + ", ".join(
    f"sum({c}) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS {c}_cum" for c in [f"{s}{x}_members" for s in _REACHED for x in _TYPE_TEST] + [f"lapsed_{s}{x}_members" for s in SETTINGS.lapsed_labels for x in _TYPE_TEST]
    + [f"{n}{x}_{k}" for n in ("delivered", "picked_up") for x in _TYPE_TEST for k in ("items", "mrr")] + [f"discount_mrr_offset{x}" for x in _TYPE_TEST]) + " FROM k_day), k_all AS (SELECT *, " + ", ".join(
    f"new{x}_members_cum - lapsed{x}_members_cum AS current{x}_members, inactive{x}_members_cum - lapsed_inactive{x}_members_cum AS current_inactive{x}_members, "
    f"active{x}_members_cum - inactive{x}_members_cum - lapsed_active{x}_members_cum AS current_active{x}_members, scheduled{x}_members_cum - active{x}_members_cum - lapsed_scheduled{x}_members_cum AS current_scheduled{x}_members, "
    f"new{x}_members_cum - scheduled{x}_members_cum - lapsed_new{x}_members_cum AS current_new{x}_members, delivered{x}_items_cum - picked_up{x}_items_cum AS active{x}_items, "
    f"delivered{x}_mrr_cum - picked_up{x}_mrr_cum AS active{x}_rental_mrr, delivered{x}_mrr_cum - picked_up{x}_mrr_cum + discount_mrr_offset{x}_cum AS active{x}_rental_mrr_net" for x in _TYPE_TEST) + \
    ", new_annual_members_cum * (149 / 12) + new_monthly_members_cum * 18.0 AS membership_mrr FROM k_cum)"
_KPI = "date:d " + " ".join(f"{s}{x}_members:i" for s in _REACHED for x in _TYPE_TEST) + " " + " ".join(
    f"current{x}_members:i current_new{x}_members:i current_scheduled{x}_members:i current_active{x}_members:i current_inactive{x}_members:i active{x}_items:i active{x}_rental_mrr:m active{x}_rental_mrr_net:m" for x in _TYPE_TEST) + " membership_mrr:f total_mrr:f total_mrr_net:f"
# Steps of a day by status and label, movements, offsets; each with its running total.
_DAILY = {f"{s}{x}_members": "i" for s in (*_REACHED, *(f"lapsed_{s}" for s in SETTINGS.lapsed_labels)) for x in _TYPE_TEST} | {
    f"{n}{x}_{k}": kind for n in ("delivered", "picked_up") for x in _TYPE_TEST for k, kind in (("items", "i"), ("mrr", "m"))} | {f"discount_mrr_offset{x}": "m" for x in _TYPE_TEST}
_PLAN = {"annual": "(149 / 12)", "monthly": "18.0"}
_RATES = {f"{s}_{p}_mrr": f"{s}_{p}_members * {r}" for s in _REACHED for p, r in _PLAN.items()} | {f"new_{p}_mrr_cum": f"new_{p}_members_cum * {r}" for p, r in _PLAN.items()} | {
    f"{s}_membership_mrr": " + ".join(f"{s}_{p}_members * {r}" for p, r in _PLAN.items()) for s in _REACHED} | {
    f"total{x}_mrr{net}": f"active{x}_rental_mrr{net} + {extra}" for x, extra in (("", "membership_mrr"), *((f"_{p}", f"new_{p}_members_cum * {r}") for p, r in _PLAN.items()), ("_per_item", "0")) for net in ("", "_net")} | {
    f"current{x}_member_{n}d_growth_pct": f"current{x}_members / nullif(lag(current{x}_members, {n}) OVER (ORDER BY date), 0) - 1" for x in _TYPE_TEST for n in (7, 30)}
_KPI = " ".join(dict.fromkeys([*_KPI.split(), *(f"{c}:{k}" for c, k in _DAILY.items()), *(f"{c}_cum:{k}" for c, k in _DAILY.items()), *(f"{c}:f" for c in _RATES)]))
query("kpis_daily", _KPI, f"{_KPI_SQL} SELECT *, " + ", ".join(f"{e} AS {c}" for c, e in _RATES.items()) + " FROM k_all")(lambda w: w.kpis)
query("growth_7d_30d", "date:d " + " ".join(f"current{x}_member_{n}d_growth_pct:f" for x in _TYPE_TEST for n in (7, 30)), f"{_KPI_SQL} SELECT date, " + ", ".join(
    f"current{x}_members / nullif(lag(current{x}_members, {n}) OVER (ORDER BY date), 0) - 1 AS current{x}_member_{n}d_growth_pct" for x in _TYPE_TEST for n in (7, 30)) + " FROM k_all")(lambda w: w.kpis)
query("kpi_unpivot", "date:d member_type:s member_status:s member_count:i", f"{_KPI_SQL} " + " UNION ALL ".join(
    f"SELECT date, '{x.lstrip('_') or 'total'}' AS member_type, '{label}' AS member_status, current_{s}{x}_members AS member_count FROM k_all" for x in _TYPE_TEST for s, label in kpis.LONG_NAMES.items()))(lambda w: w.kpi_long)
query("new_customers", "date:d annual_members:i monthly_members:i other_members:i gifters:i registry_buyers:i", """
    SELECT date, coalesce(a, 0) AS annual_members, coalesce(m, 0) AS monthly_members, coalesce(o, 0) AS other_members, coalesce(g, 0) AS gifters, coalesce(r, 0) AS registry_buyers FROM o_days LEFT JOIN (
        SELECT CAST(t AS DATE) AS date, sum(CASE WHEN membership_type = 'annual' THEN 1 ELSE 0 END) AS a, sum(CASE WHEN membership_type = 'monthly' THEN 1 ELSE 0 END) AS m,
               sum(CASE WHEN membership_type IN ('per-item', 'influencer') THEN 1 ELSE 0 END) AS o, sum(CASE WHEN membership_type = 'gift-card-buyer' THEN 1 ELSE 0 END) AS g, sum(CASE WHEN membership_type = 'registry-product-buyer' THEN 1 ELSE 0 END) AS r
        FROM o_members JOIN (SELECT member_id, min(transaction_ts) AS t FROM o_ledger GROUP BY 1) USING (member_id) GROUP BY 1) USING (date)""")(lambda w: w.new_customers)
_num = lambda c: f"CAST(replace(replace(nullif(trim({c}), ''), ',', ''), '$', '') AS DOUBLE)"
query("targets", "date:d " + cols("gross_new_bay churn_bay total_members_bay gross_new_nyc churn_nyc total_members_nyc", "f"), "SELECT date, " + ", ".join(
    f"{_num(c)} AS {c}" for c in "gross_new_bay churn_bay total_members_bay gross_new_nyc churn_nyc total_members_nyc".split()) + " FROM b_daily_targets")(lambda w: kpis.daily_targets(w.source("daily_targets")))
query("waterfall", "location:s date:d actual_new:i actual_churn:i actual_net:i target_new:f target_churn:f target_net:f actual_total:i target_total:f", f"""
    WITH t AS (SELECT CAST(date AS DATE) AS date, 'SF' AS location, {_num('gross_new_bay')} AS target_new, {_num('churn_bay')} AS target_churn, {_num('total_members_bay')} AS target_total FROM b_daily_targets
               UNION ALL SELECT CAST(date AS DATE), 'NYC', {_num('gross_new_nyc')}, {_num('churn_nyc')}, {_num('total_members_nyc')} FROM b_daily_targets),
    n AS (SELECT membership_start_dt AS date, ops_location AS location, count(*) AS n FROM o_members GROUP BY 1, 2), c AS (SELECT membership_end_dt AS date, ops_location AS location, -count(*) AS n FROM o_members GROUP BY 1, 2),
    j AS (SELECT t.*, coalesce(n.n, 0) AS actual_new, coalesce(c.n, 0) AS actual_churn FROM t LEFT JOIN n USING (date, location) LEFT JOIN c USING (date, location))
    SELECT *, actual_new + actual_churn AS actual_net, coalesce(target_new, 0) + coalesce(target_churn, 0) AS target_net,
           coalesce((SELECT sum(x.n) FROM (SELECT * FROM n UNION ALL SELECT * FROM c) x WHERE x.location = j.location AND x.date <= j.date), 0) AS actual_total FROM j""")(lambda w: w.waterfall)
_MRR_SQL = f"""
    WITH mon AS (SELECT CAST(m AS DATE) AS month, CAST(m + INTERVAL 1 MONTH AS DATE) AS nxt FROM (SELECT unnest(generate_series({FIRST}, {AS_OF} - 1, INTERVAL 1 MONTH)) AS m)),
    base AS (SELECT m.member_id, m.first_name, m.last_name, m.membership_type, mon.month, CASE m.membership_type WHEN 'annual' THEN 149 / 12 WHEN 'monthly' THEN 18.0 ELSE 0 END AS membership_mrr,
                count(avg_price) AS items, CAST(sum(avg_price) AS DOUBLE) AS item_mrr
             FROM o_rentals r JOIN o_members m ON m.member_id = r.member_id JOIN mon ON least(nxt, {AS_OF}) > r.delivery_date AND least(nxt, {AS_OF}) < coalesce(r.pick_up_date, DATE '9999-12-31') GROUP BY ALL),
    piv AS (SELECT member_id, first_name, last_name, membership_type, membership_mrr, avg(item_mrr + membership_mrr) AS member_monthly_avg_mrr, avg(item_mrr) AS member_monthly_avg_item_mrr,
                sum(item_mrr + membership_mrr) AS member_monthly_sum_mrr, sum(item_mrr) AS member_monthly_sum_item_mrr, """ + ", ".join(
    f"sum(CASE WHEN month = DATE '{d}' THEN items END) AS items_{n}, sum(CASE WHEN month = DATE '{d}' THEN item_mrr END) AS item_mrr_{n}, sum(CASE WHEN month = DATE '{d}' THEN item_mrr + membership_mrr END) AS total_mrr_{n}, "
    f"sum(CASE WHEN month = DATE '{d}' THEN item_mrr END) / nullif(sum(CASE WHEN month = DATE '{d}' THEN items END), 0) AS avg_item_mrr_{n}" for n, d in SETTINGS.mrr_months.items()) + " FROM base GROUP BY 1, 2, 3, 4, 5)"
query("mrr_pivot", "member_id:s membership_type:s membership_mrr:f member_monthly_avg_mrr:f member_monthly_avg_item_mrr:f member_monthly_sum_mrr:f member_monthly_sum_item_mrr:f " + " ".join(
    f"items_{n}:i item_mrr_{n}:f avg_item_mrr_{n}:f total_mrr_{n}:f" for n in SETTINGS.mrr_months), f"{_MRR_SQL} SELECT * FROM piv")(
    lambda w: w.mrr_pivot)
query("mrr_reshape", "member_id:s first_name:s membership_type:s member_monthly_sum_item_mrr:f membership_mrr:f monthly_metric_type:s jan:f feb:f mar:f cust_rank:i row_order:i", f"""
    {_MRR_SQL}, r AS (SELECT *, row_number() OVER (ORDER BY round(member_monthly_sum_item_mrr, 2) DESC NULLS LAST, member_id) AS cust_rank FROM piv),
    u AS (SELECT member_id, first_name, membership_type, member_monthly_sum_item_mrr, membership_mrr, '1. ITEM MRR' AS monthly_metric_type, item_mrr_jan AS jan, item_mrr_feb AS feb, item_mrr_mar AS mar, cust_rank FROM r
          UNION ALL SELECT member_id, '', '', NULL, NULL, '2. ITEM QTY', items_jan, items_feb, items_mar, cust_rank FROM r
          UNION ALL SELECT member_id, '', '', NULL, NULL, '3. MRR/ITEM', avg_item_mrr_jan, avg_item_mrr_feb, avg_item_mrr_mar, cust_rank FROM r)
    SELECT *, row_number() OVER (ORDER BY cust_rank, monthly_metric_type) AS row_order FROM u""")(lambda w: kpis.mrr_reshape(w.mrr_pivot, list(SETTINGS.mrr_months)))

# --- ads -------------------------------------------------------------------

query("campaign_dim", "campaign_id:s src_campaign_id:s campaign_name:s status:s channel_id:s", "o_campaigns")(lambda w: w.campaigns)
_AD_SQL = """key AS (SELECT ad_name, min(snoop) AS snoop, min(ny) AS ny FROM b_ad_key GROUP BY 1),
    ad AS (SELECT md5('facebook-' || s.id) AS ad_id, md5('facebook-' || account_id) AS ad_account_id, md5('facebook-' || campaign_id) AS campaign_id, md5('facebook-' || adset_id) AS audience_id, 'facebook' AS ad_source, s.name AS ad_name,
                  s.status, s.id AS source_ad_id, campaign_id AS source_campaign_id, snoop, ny FROM b_social_ads s LEFT JOIN key ON key.ad_name = s.name
           UNION ALL SELECT md5('google-' || a.id), md5('google-' || a.adwords_customer_id), md5('google-' || g.campaign_id), md5('google-' || a.ad_group_id),
                  CASE WHEN a.type ILIKE '%search%' THEN 'adwords_search' WHEN a.type ILIKE '%image%' THEN 'adwords_display' END, g.name, a.status, a.id, g.campaign_id, NULL, NULL FROM b_ads a LEFT JOIN b_ad_groups g ON g.id = a.ad_group_id),
    perf AS (SELECT md5('google-' || r.id) AS ad_performance_id, md5('google-' || a.id) AS ad_id, CAST(date_start AS DATE) AS date, md5('google-' || g.campaign_id) AS campaign_id, a.type AS ad_type, final_urls,
                    cost / 1000000 AS spend, impressions, clicks FROM b_ad_reports r LEFT JOIN b_ads a ON a.id = r.ad_id LEFT JOIN b_ad_groups g ON g.id = a.ad_group_id
             UNION ALL SELECT md5('facebook-' || i.id), md5('facebook-' || s.id), CAST(date_start AS DATE), md5('facebook-' || s.campaign_id), NULL, url_parameters, spend, impressions, link_clicks
             FROM b_social_insights i LEFT JOIN b_social_ads s ON s.id = i.ad_id)"""
query("ad_dim", "ad_id:s ad_account_id:s campaign_id:s audience_id:s ad_source:s ad_name:s status:s source_ad_id:s source_campaign_id:s snoop:s ny:s", f"WITH {_AD_SQL} SELECT * FROM ad")(lambda w: w.ad_dim)
query("ad_performance", "ad_performance_id:s ad_id:s date:d campaign_id:s ad_type:s final_urls:s spend:m impressions:i clicks:i", f"WITH {_AD_SQL} SELECT * FROM perf")(lambda w: w.ad_performance)
_SPEND_SQL = f"""{_AD_SQL}, spend AS (SELECT CASE WHEN ad_source = 'facebook' AND ny = 'yes' THEN 'facebook - NY' WHEN ad_source = 'facebook' AND (ny = 'no' OR ny IS NULL) THEN 'facebook - SF' ELSE ad_source END AS ad_source, date,
        sum(CAST(spend AS DECIMAL(18,2))) AS spend, sum(impressions) AS impressions, sum(clicks) AS clicks FROM perf LEFT JOIN ad USING (ad_id) LEFT JOIN (SELECT DISTINCT ad_name AS n FROM b_ad_key WHERE snoop = 'yes') f ON f.n = ad.ad_name AND ad.ad_source = 'facebook'
        WHERE f.n IS NULL GROUP BY 1, 2)"""
query("ad_spend", "ad_source:s date:d spend:m impressions:i clicks:i", f"WITH {_SPEND_SQL} SELECT * FROM spend")(lambda w: ads.ad_spend_by_day(w.ad_performance, w.ad_dim, w.source("ad_key")))
_CH = ("facebook_sf", "facebook_ny", "google_search", "google_display")
query("channel_daily", "date:d " + " ".join(f"{p}_spend:m {p}_impressions:i {p}_clicks:i {p}_cpm:m {p}_cpc:m {p}_ctr:m" for p in (*_CH, "facebook_total")) + " paid_marketing_spend:m new_members:i order_discounts:m paid_marketing_cac:m cac:m "
      "first_order_flagship_only:i sessions:i adds_to_cart:i product_viewed:i checkout_started:i order_completed:i cost_per_atc:m", f"WITH {_SPEND_SQL}, src AS (SELECT date, " + ", ".join(
    f"sum(CASE WHEN ad_source = '{s}' THEN {m} ELSE 0 END) AS {p}_{m}" for p, s in ads.REPORT_SOURCES.items() for m in ("spend", "impressions", "clicks")) + " FROM spend GROUP BY 1), n AS (SELECT membership_start_dt AS date, count(*) FILTER (WHERE membership_type IN ('annual', 'monthly')) AS new_members FROM o_members GROUP BY 1), "
    "o AS (SELECT CAST(order_ts AS DATE) AS date, sum(order_discounts) AS order_discounts FROM o_orders GROUP BY 1), f AS (SELECT CAST(session_start_ts AS DATE) AS date, count(DISTINCT session_id) AS sessions, count(DISTINCT CASE WHEN src_tbl = 'product_added' THEN session_id END) AS adds_to_cart, " + ", ".join(f"count(DISTINCT CASE WHEN src_tbl = '{k}' THEN session_id END) AS {k}" for k in ("product_viewed", "checkout_started", "order_completed")) + " "
    "FROM o_web WHERE NOT is_internal AND membership_state = 'new' GROUP BY 1), fl AS (SELECT m.membership_start_dt AS date, sum(CASE WHEN " + _pick("basket_ct", 1) + " = 1 AND " + _pick("has_flagship", 1) + " = 1 THEN 1 ELSE 0 END) AS v "
    "FROM o_members m LEFT JOIN o_order_baskets o1 ON o1.member_id = m.member_id AND o1.dense_rank = 1 LEFT JOIN o_rental_baskets r1 ON r1.member_id = m.member_id AND r1.dense_rank = 1 GROUP BY 1), "
    "j AS (SELECT date, " + ", ".join(f"coalesce({p}_{m}, 0) AS {p}_{m}" for p in _CH for m in ("spend", "impressions", "clicks")) + ", coalesce(new_members, 0) AS new_members, order_discounts, sessions, adds_to_cart, product_viewed, checkout_started, order_completed, coalesce(fl.v, 0) AS first_order_flagship_only "
    "FROM o_days LEFT JOIN src USING (date) LEFT JOIN n USING (date) LEFT JOIN o USING (date) LEFT JOIN f USING (date) LEFT JOIN fl USING (date)), t AS (SELECT *, " + ", ".join(f"facebook_sf_{m} + facebook_ny_{m} AS facebook_total_{m}" for m in ("spend", "impressions", "clicks")) + ", " + " + ".join(f"{p}_spend" for p in _CH) + " AS paid FROM j) "
    "SELECT *, paid AS paid_marketing_spend, CAST(paid AS DOUBLE) / nullif(adds_to_cart, 0) AS cost_per_atc, CAST(paid AS DOUBLE) / nullif(new_members, 0) AS paid_marketing_cac, CAST(paid + coalesce(order_discounts, 0) AS DOUBLE) / nullif(new_members, 0) AS cac, " + ", ".join(
    f"coalesce(CAST({p}_spend AS DOUBLE) * 1000 / nullif({p}_impressions, 0), 0) AS {p}_cpm, coalesce(CAST({p}_spend AS DOUBLE) / nullif({p}_clicks, 0), 0) AS {p}_cpc, coalesce(CAST({p}_clicks AS DOUBLE) / nullif({p}_impressions, 0), 0) AS {p}_ctr" for p in (*_CH, "facebook_total")) + " FROM t")(
    lambda w: w.channel_daily)

# --- URLs, text, keys ------------------------------------------------------

query("url_parts", "page_id:i host:s page_parameter:s utm_source:s before_query:s", """
    SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page_parameter,
           nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source, split_part(url, '?', 1) AS before_query FROM pages""")(
    lambda w: w.table("pages").select("page_id", F.try_parse_url("url", F.lit("HOST")).alias("host"), exprs.url_parameter("url", "page").alias("page_parameter"),
                                      exprs.url_parameter("url", "utm_source").alias("utm_source"), exprs.before("url", "?").alias("before_query")))
query("url_normalise", "page:s handle:s n:i", """
    SELECT page, CASE WHEN t LIKE '%/%' THEN NULL ELSE t END AS handle, count(*) AS n FROM (
        SELECT lower(regexp_replace(regexp_replace(url, '^https?://[^/]*/', '/'), '\\?.*', '')) AS page, regexp_replace(regexp_replace(url, '.*en/', ''), '\\?.*', '') AS t FROM pages) GROUP BY 1, 2""")(
    lambda w: w.table("pages").groupBy(exprs.url_path("url").alias("page"), exprs.page_handle("url", "en/").alias("handle")).agg(F.count(F.lit(1)).alias("n")))
query("source_keys", "o_orderkey:i key:s id_text:s", "SELECT o_orderkey, md5('store-' || CAST(o_orderkey AS VARCHAR)) AS key, split_part(CAST(o_orderkey AS VARCHAR) || '.0', '.', 1) AS id_text FROM orders")(
    lambda w: w.table("orders").select("o_orderkey", exprs.source_key("store", "o_orderkey").alias("key"), exprs.number_id(F.concat(F.col("o_orderkey").cast("string"), F.lit(".0"))).alias("id_text")))
_PRICE = "CASE o_orderstatus WHEN 'F' THEN '$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) WHEN 'O' THEN '1,' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) WHEN 'P' THEN CASE o_orderpriority WHEN '5-LOW' THEN 'abc' WHEN '2-HIGH' THEN ' ' ELSE '12.9' END END"
_strip = f"replace(replace(nullif(trim({_PRICE}), ''), ',', ''), '$', '')"
query("parse_money", "o_orderkey:i number:f money:m whole:i", f"""
    SELECT o_orderkey, TRY_CAST({_strip} AS DOUBLE) AS number, TRY_CAST({_strip} AS DECIMAL(18,2)) AS money, TRY_CAST(split_part({_strip}, '.', 1) AS INT) AS whole FROM orders""")(
    lambda w: w.table("orders").select("o_orderkey", exprs.parse_number(F.expr(_PRICE)).alias("number"), exprs.parse_money(F.expr(_PRICE)).alias("money"), exprs.parse_whole(F.expr(_PRICE)).alias("whole")))
query("bins", "bin:s n:i total:m", """
    SELECT CASE WHEN l_quantity < 10 THEN '< 10' WHEN l_quantity < 20 THEN '10 - 20' WHEN l_quantity < 40 THEN '20 - 40' ELSE '40+' END AS bin, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem GROUP BY 1""")(
    lambda w: w.table("lineitem").groupBy(exprs.binned("l_quantity", (10, 20, 40)).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum(exprs.money("l_extendedprice")).alias("total")))
query("device_class", "device:s events:i", "SELECT CASE WHEN context_user_agent ILIKE '%iphone%' THEN 'iPhone' WHEN context_user_agent ILIKE '%android%' THEN 'Android' WHEN context_user_agent IS NOT NULL THEN 'PC' END AS device, count(*) AS events FROM b_events GROUP BY 1")(
    lambda w: w.source("events").groupBy(web.device_class("context_user_agent").alias("device")).agg(F.count(F.lit(1)).alias("events")))

# --- joins and keyed picks -------------------------------------------------

query("anti_missing", "key:s", "SELECT DISTINCT context_ip AS key FROM b_events WHERE context_ip IS NOT NULL AND NOT EXISTS (SELECT 1 FROM b_geo WHERE ip_id = context_ip)")(
    lambda w: incremental.missing_keys(w.source("events"), w.source("geo"), "context_ip", "ip_id"))
query("missing_recent", "key:s", "SELECT DISTINCT context_ip AS key FROM b_events WHERE timestamp >= TIMESTAMP '2001-05-25' AND NOT EXISTS (SELECT 1 FROM b_geo WHERE ip_id = context_ip)")(
    lambda w: incremental.missing_keys(w.source("events"), w.source("geo"), "context_ip", "ip_id", "2001-05-25", "timestamp"))
query("semi_keys", "c_custkey:i c_name:s", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01')")(
    lambda w: payload.children_of(w.table("customer").select("c_custkey", "c_name"), w.table("orders").filter("o_orderdate >= timestamp '2001-01-01'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey"))
query("topn_latest", "o_custkey:i o_orderkey:i o_orderdate:t", "SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")(
    lambda w: ordered.first_rows(w.table("orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]))
query("topn_two", "o_custkey:i o_orderkey:i", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn <= 2")(
    lambda w: ordered.first_rows(w.table("orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", ["o_orderdate", "o_orderkey"], 2))
query("order_sequence", "o_custkey:i o_orderkey:i rn:i", "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders")(
    lambda w: ordered.numbered(w.table("orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", "o_orderdate", ["o_orderkey"]))
query("revenue_rank", "c_custkey:i total:m rn:i", """
    SELECT *, row_number() OVER (ORDER BY total DESC, c_custkey) AS rn FROM (SELECT o_custkey AS c_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1)""")(
    lambda w: ordered.numbered_all(w.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum(exprs.money("o_totalprice")).alias("total")), [F.col("total").desc(), F.col("c_custkey")]))
query("first_lines", "l_orderkey:i l_linenumber:i l_partkey:i is_first:b", """
    SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) = 1 AS is_first FROM lineitem""")(
    lambda w: ordered.flag_first(w.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"), "l_orderkey", ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"], "is_first"))
query("lookup_names", "o_orderkey:i c_name:s", "SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON c_custkey = CASE WHEN o_orderstatus <> 'O' THEN o_custkey END")(
    lambda w: ordered.lookup(w.table("orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")).alias("c_custkey")), w.table("customer").select("c_custkey", "c_name"), "c_custkey"))

# --- refreshes -------------------------------------------------------------

_ORDER = "o_orderkey:i o_custkey:i o_orderstatus:s o_orderdate:t"
_old = lambda w: w.table("orders").filter("o_orderdate < timestamp '2000-01-01'")
_new = lambda w: w.table("orders").filter("o_orderdate >= timestamp '1999-01-01'").withColumn("o_orderstatus", F.lit("X"))
query("upsert", _ORDER, "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' UNION ALL SELECT * REPLACE ('X' AS o_orderstatus) FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'")(
    lambda w: incremental.upsert(_old(w), _new(w), ["o_orderkey"]))
query("window_replace", _ORDER, """
    SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
    UNION ALL SELECT * REPLACE ('X' AS o_orderstatus) FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""")(lambda w: incremental.replace_window(_old(w), _new(w), ["o_custkey"]))
query("routed_window", _ORDER, CATALOG["window_replace"].sql)(lambda w: _routed_window(w))
query("changed_since", "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i", "SELECT l.* FROM lineitem l JOIN orders ON o_orderkey = l_orderkey WHERE o_orderdate > TIMESTAMP '2000-06-01'")(
    lambda w: incremental.changed_since(w.table("lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderdate", "2000-06-01", w.table("orders"), "o_orderkey").withColumnRenamed("o_orderkey", "l_orderkey"))
query("hwm", "mark:t", "SELECT max(greatest(o_orderdate, o_orderdate + INTERVAL 1 DAY)) AS mark FROM orders")(
    lambda w: incremental.high_water_mark(w.table("orders").withColumn("changed", F.expr("o_orderdate + interval 1 day")), ["o_orderdate", "changed"]))
query("incremental", _ORDER, "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' - INTERVAL 1 SECOND")(lambda w: incremental.incremental(w.table("orders"), "o_orderdate", "2001-01-01"))
query("insert_update_split", "o_orderkey:i change:s row_id:i", """
    SELECT n.o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'insert' ELSE 'update' END AS change, o.o_orderkey * 10 AS row_id FROM (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01') n
    LEFT JOIN (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01') o USING (o_orderkey)""")(lambda w: _split(w))
query("delete_after", _ORDER, "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-07-01'")(lambda w: incremental.delete_from(w.table("orders"), "o_orderdate", "1998-07-01"))
query("batches", "c_custkey:i batch:i", "SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // 100 AS batch FROM customer")(
    lambda w: incremental.assign_batches(w.table("customer").select("c_custkey"), "c_custkey"))


def _split(w):
    known = _old(w).select("o_orderkey", (F.col("o_orderkey") * 10).alias("row_id"))
    inserts, updates = incremental.split_changes(_new(w).select("o_orderkey"), known, ["o_orderkey"])
    return inserts.withColumn("change", F.lit("insert")).withColumn("row_id", F.lit(None).cast("bigint")).unionByName(updates.withColumn("change", F.lit("update")))


# --- quality and export ----------------------------------------------------

query("dup_keys", "l_orderkey:i l_linenumber:i n:i", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")(
    lambda w: quality.check_unique(w.table("lineitem"), ["l_orderkey", "l_linenumber"]))
query("null_keys", "id:i anonymous_id:s", "SELECT id, anonymous_id FROM b_events WHERE user_id IS NULL")(lambda w: quality.check_not_null(w.source("events"), "user_id"))
query("key_report", "table_name:s key_name:s row_count:i null_keys:i repeated_keys:i", """
    SELECT 'orders' AS table_name, 'order_id' AS key_name, count(*) AS row_count, 0 AS null_keys, count(*) - count(DISTINCT order_id) AS repeated_keys FROM o_orders
    UNION ALL SELECT 'events', 'user_id', (SELECT count(*) FROM b_events), (SELECT count(*) FROM b_events WHERE user_id IS NULL), (SELECT count(*) FROM (SELECT user_id FROM b_events WHERE user_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1))""")(
    lambda w: quality.key_report({"orders": (w.orders, "order_id"), "events": (w.source("events"), "user_id")}))
query("freshness", "table_name:s row_count:i latest_ts:t lag_s:i", """
    SELECT 'orders' AS table_name, count(*) AS row_count, max(o_orderdate) AS latest_ts, date_diff('second', max(o_orderdate), TIMESTAMP '2024-02-01') AS lag_s FROM orders
    UNION ALL SELECT 'events', count(*), max(ts), epoch(TIMESTAMP '2024-02-01') - floor(epoch(max(ts))) FROM events""")(
    lambda w: export.freshness({"orders": w.table("orders"), "events": w.table("events")}, {"orders": "o_orderdate", "events": "ts"}, "2024-02-01 00:00:00"))
query("export_text", cols("o_orderkey o_orderdate is_open o_clerk", "s"), "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS o_orderdate, CASE WHEN o_orderstatus = 'O' THEN 'true' ELSE 'false' END AS is_open, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE '' END AS o_clerk FROM orders")(
    lambda w: export.to_text(w.table("orders").withColumn("is_open", F.col("o_orderstatus") == "O").withColumn("o_clerk", F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority"))), ["o_orderkey", "o_orderdate", "is_open", "o_clerk", "absent"]))
query("export_filtered", "c_custkey:i c_acctbal:m", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000")(
    lambda w: export.export(w.table("customer").select("c_custkey", "c_acctbal"), "c_acctbal > 5000", ["c_acctbal", "c_custkey"]))
query("export_cells", "row:s", """
    SELECT '{"id":' || c_custkey || ',"cells":[{"columnId":11,"value":"' || c_name || '"},{"columnId":12,"value":"' || c_mktsegment || '"}]}' AS row FROM customer""")(
    lambda w: export.to_cells(w.table("customer"), {"c_name": 11, "c_mktsegment": 12, "absent": 13}, "c_custkey"))

# --- payload shaping -------------------------------------------------------

query("union_padded", "src_tbl:s user_id:i value:f o_totalprice:m", "SELECT src_tbl, user_id, value, o_totalprice FROM (SELECT 'events' AS src_tbl, user_id, value FROM events UNION ALL BY NAME SELECT 'orders' AS src_tbl, o_totalprice FROM orders)")(
    lambda w: payload.union_events({"events": w.table("events").select("user_id", "value"), "orders": w.table("orders").select("o_totalprice")}))
query("explode_child", "id:s amount:s order_id:s", "SELECT json_extract_string(i, '$.code') AS id, json_extract_string(i, '$.amount') AS amount, id AS order_id FROM (SELECT id, unnest(CAST(discount_codes AS JSON[])) AS i FROM b_orders)")(
    lambda w: payload.explode_child(w.source("orders").select("id", exprs.json_rows("discount_codes", "code string, amount string").alias("codes")), "codes", "id", "order_id").withColumnRenamed("code", "id"))
query("flatten", "event_id:i k:i", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")(
    lambda w: payload.flatten_struct(w.table("events").select("event_id", F.from_json("props", "k int").alias("properties"))))
query("stringified", "event_id:i properties:s", """SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || '}' AS properties FROM events""")(
    lambda w: payload.stringify_nested(w.table("events").select("event_id", F.from_json("props", "k int").alias("properties"))))
query("prefixed", "id:s addr_city:s addr_province:s", "SELECT id, json_extract_string(shipping_address, '$.city') AS addr_city, json_extract_string(shipping_address, '$.province') AS addr_province FROM b_orders")(
    lambda w: payload.prefix_struct(w.source("orders").select("id", F.from_json("shipping_address", "city string, province string, zip string").alias("a"), "refunds"), "a", ["city", "province"], "addr_", ["refunds"]))
query("first_by", "user_id:i event_id:i event_type:s", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")(
    lambda w: payload.first_by(w.table("events"), ["user_id"], ["ts", "event_id"]))
_CELLS = """'{"6":{"value":' || CAST(event_id AS STRING) || '},"7":{"value":{"id":"u' || CAST(user_id AS STRING) || '","url":"x"}},"8":{"value":{"id":1,"url":"f/' || event_type || '"}}}'"""
query("unwrap_cells", "event:s person:s receipt:s gone:s", "SELECT CAST(event_id AS VARCHAR) AS event, 'u' || CAST(user_id AS VARCHAR) AS person, 'f/' || event_type AS receipt, NULL AS gone FROM events")(
    lambda w: payload.unwrap_cells(w.table("events").select(F.expr(_CELLS).alias("p")), "p", {"6": "event", "7": "person", "8": "receipt", "9": "gone"}, ["receipt"]))
_SPEC = TableSpec.of({"id": "int", "price": "float", "day": "date", "code": "varchar(3)"})
_TEXT = ("CAST(o_orderkey AS STRING) AS id, CASE o_orderstatus WHEN 'F' THEN 'n/a' WHEN 'O' THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS price, "
         "CASE o_orderpriority WHEN '5-LOW' THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS day, o_orderpriority AS code")
_TEXT_SQL = f"x AS (SELECT {_TEXT} FROM orders)"
query("conform", "id:i price:m day:d code:s", f"WITH {_TEXT_SQL} SELECT CAST(id AS INT) AS id, TRY_CAST(nullif(price, '') AS DOUBLE) AS price, TRY_CAST(day AS DATE) AS day, substring(code, 1, 3) AS code FROM x WHERE price <> 'n/a' AND day <> 'soon'")(
    lambda w: conform.conform(_text_orders(w), _SPEC)[0])
query("conform_rejected", "id:s price:s day:s lost:s", f"WITH {_TEXT_SQL} SELECT id, price, day, CASE WHEN price = 'n/a' AND day = 'soon' THEN 'price,day' WHEN price = 'n/a' THEN 'price' ELSE 'day' END AS lost FROM x WHERE price = 'n/a' OR day = 'soon'")(
    lambda w: conform.conform(_text_orders(w), _SPEC)[1].withColumn("lost", F.array_join("_lost", ",")))
_PROFILE = _TEXT + ", CAST(o_orderkey * 100000000 AS STRING) AS big_id, CASE o_orderstatus WHEN 'O' THEN 'true' ELSE 'false' END AS is_open, CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:30:00' AS placed_at"
query("type_profile", "column_name:s set_values:i as_int:i as_bigint:i as_double:i as_date:i as_timestamp:i as_boolean:i proposed_type:s", f"""
    WITH x AS (SELECT {_PROFILE} FROM orders), v AS (UNPIVOT x ON id, price, day, code, big_id, is_open, placed_at INTO NAME column_name VALUE v),
    c AS (SELECT column_name, count(nullif(v, '')) AS set_values, count(CASE WHEN regexp_matches(v, '^[0-9]+$') THEN TRY_CAST(v AS INT) END) AS as_int, count(CASE WHEN regexp_matches(v, '^[0-9]+$') THEN 1 END) AS as_bigint,
                 count(CASE WHEN regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}( [0-9:]+)?$') THEN 1 END) AS as_timestamp, count(CASE WHEN v IN ('true', 'false', '0', '1') THEN 1 END) AS as_boolean, count(CASE WHEN regexp_matches(v, '^[0-9]+([.][0-9]+)?$') THEN 1 END) AS as_double,
                 count(CASE WHEN regexp_matches(v, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN 1 END) AS as_date FROM v GROUP BY 1)
    SELECT *, CASE WHEN as_int = set_values THEN 'int' WHEN as_bigint = set_values THEN 'bigint' WHEN as_double = set_values THEN 'double' WHEN as_date = set_values THEN 'date'
                   WHEN as_timestamp = set_values THEN 'timestamp' WHEN as_boolean = set_values THEN 'boolean' ELSE 'text' END AS proposed_type FROM c""")(
    lambda w: conform.profile_types(w.spark.sql(f"SELECT {_PROFILE} FROM {{t}}", t=w.table("orders"))))
query("drift", "key:s row_count:i sample:s", "SELECT json_key AS key, count(*) AS row_count, min(v) AS sample FROM (SELECT unnest(json_keys(shipping_address)) AS json_key, json_extract_string(shipping_address, json_key) AS v FROM b_orders) WHERE json_key NOT IN ('name', 'city') GROUP BY 1")(
    lambda w: conform.schema_drift(w.source("orders"), "shipping_address", ["name", "city"]))
query("variant_fields", "id:s city:s province:s", "SELECT id, json_extract_string(shipping_address, '$.city') AS city, json_extract_string(shipping_address, '$.province') AS province FROM b_orders")(
    lambda w: variants.fields(w.source("orders").select("id", "shipping_address"), "shipping_address", {n: (f"$.{n}", "string") for n in ("city", "province")}))
query("variant_drift", "key:s row_count:i sample:s type:s", CATALOG["drift"].sql.replace("min(v) AS sample", "min(v) AS sample, 'STRING' AS type"))(
    lambda w: variants.drift(w.source("orders"), "shipping_address", ["name", "city"]))
query("aliases", "customer:s status:s absent:s", "SELECT CAST(o_custkey AS VARCHAR) AS customer, coalesce(CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END, o_orderstatus) AS status, NULL AS absent FROM orders")(
    lambda w: conform.resolve_aliases(w.table("orders").select(F.col("o_custkey").cast("string").alias("cust"), F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).alias("a"), F.col("o_orderstatus").alias("b")),
                                      TableSpec((Field("customer", keys=("client", "cust")), Field("status", keys=("a", "b")), Field("absent")))))
query("projected", "o_orderkey:i o_clerk:s", "SELECT o_orderkey, '-' AS o_clerk FROM orders")(
    lambda w: conform.fill_missing(w.table("orders"), TableSpec.of({"o_orderkey": "bigint", "o_clerk": "text"}), "-"))
query("product_dim", "sku:s product_name:s product_created_ts:t product_updated_ts:t product_published_ts:t product_page_handle:s product_status:s product_tags:s", """
    SELECT id AS sku, title AS product_name, created_at AS product_created_ts, updated_at AS product_updated_ts, published_at AS product_published_ts, handle AS product_page_handle, status AS product_status, tags AS product_tags
    FROM b_products""")(lambda w: commerce.dim_product(w.source("products")))
query("role_addresses", "id:s town:s address_function:s", """
    SELECT id, town, role AS address_function FROM (SELECT *, row_number() OVER (PARTITION BY role, id ORDER BY o_orderkey) AS rn FROM (
        SELECT o_orderkey, 'billing' AS role, 'a' || CAST(o_custkey % 50 AS VARCHAR) AS id, 'town ' || CAST(o_orderkey % 9 AS VARCHAR) AS town FROM orders
        UNION ALL SELECT o_orderkey, 'shipping', 'a' || CAST(o_custkey % 70 AS VARCHAR), 'town ' || CAST(o_orderkey % 11 AS VARCHAR) FROM orders WHERE o_orderstatus <> 'O')) WHERE rn = 1""")(
    lambda w: payload.role_addresses(_roles(w), ["billing", "shipping"], ["o_orderkey"]))
query("renamed", "order_key_no:i orderstatus_:s", "SELECT o_orderkey AS order_key_no, o_orderstatus AS orderstatus_ FROM orders")(
    lambda w: payload.normalize_columns(w.table("orders").select(F.col("o_orderkey").alias("Order Key #No"), F.col("o_orderstatus").alias("Order-Status  "))))
query("enriched_status", "status:s user_id:i event_id:i outcome:s", """
    SELECT status, user_id, event_id, CASE WHEN status = 'success' THEN 'good' ELSE 'bad' END AS outcome
    FROM (SELECT event_id, user_id, CASE event_type WHEN 'view' THEN 'success' WHEN 'error' THEN 'fail' END AS status FROM events)""")(lambda w: _statuses(w))
query("row_counts", "table_name:s enough:b in_bounds:b", """
    SELECT 'orders' AS table_name, count(*) >= 100 AS enough, count(*) BETWEEN 1 AND 500 AS in_bounds FROM orders UNION ALL SELECT 'nation', count(*) >= 100, count(*) BETWEEN 1 AND 500 FROM nation""")(lambda w: _row_counts(w))
query("calendar_fill", "date:d ordinal:i orders:i", f"""
    SELECT d.date, n.ordinal, count(o_orderkey) AS orders FROM o_days d CROSS JOIN (SELECT unnest(range(0, 3)) AS ordinal) n
    LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d.date AND o_orderkey % 3 = n.ordinal GROUP BY 1, 2""")(lambda w: _calendar_fill(w))
query("month_fill", "month:d orders:i", f"""
    SELECT month, count(o_orderkey) AS orders FROM (SELECT CAST(unnest(generate_series({FIRST}, {AS_OF}, INTERVAL 1 MONTH)) AS DATE) AS month)
    LEFT JOIN orders ON date_trunc('month', o_orderdate) = month GROUP BY 1""")(
    lambda w: calendar.month_spine(w.spark, SETTINGS.first_day, SETTINGS.as_of).join(
        w.table("orders").select(F.trunc("o_orderdate", "month").alias("month"), "o_orderkey"), "month", "left").groupBy("month").agg(F.count("o_orderkey").alias("orders")))
_MONTHS = ["1995-01-01", "1996-01-01", "1997-01-01"]
query("retention_sheet", "cohort_size:f cohort_month:d month:d engagement_pct:f expected_clients:f", """
    WITH c AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS cohort_month, count(*) AS n, """ + ", ".join(f"count(*) FILTER (WHERE o_custkey % {k} = 0) AS p{k}" for k in (2, 3, 5)) + """ FROM orders GROUP BY 1)
    SELECT CAST(n AS DOUBLE) AS cohort_size, cohort_month, m.month, v / 100 AS engagement_pct, n * v / 100 AS expected_clients
    FROM c, LATERAL (SELECT DATE '1995-01-01' AS month, p2 * 1.0 AS v UNION ALL SELECT DATE '1996-01-01', p3 * 1.0 UNION ALL SELECT DATE '1997-01-01', 0.0 * p5) m""")(
    lambda w: payload.melt_retention(_retention(w), "row", ["a", "b", "c", "d", "e"], _MONTHS))
# --- files there and back ---------------------------------------------------

query("landing_round_trip", "o_orderkey:i o_totalprice:m o_orderdate:d o_clerk:s", "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, o_orderdate, substring(o_clerk, 1, 8) AS o_clerk FROM (SELECT *, o_orderpriority AS o_clerk FROM orders)")(
    lambda w: _landed(w))
query("csv_round_trip", "id:i name:s note:s", "SELECT c_custkey AS id, c_name AS name, c_mktsegment || ', \"' || CAST(c_nationkey AS VARCHAR) || '\"' AS note FROM customer")(lambda w: _csv(w))
query("quoted_csv", "value:s", "SELECT format('{},\"{}\",\"\"\"{}\"\"\",{}', c_custkey, c_name, c_mktsegment, c_nationkey) AS value FROM customer")(lambda w: _quoted(w))
query("published", _ORDER, "SELECT * FROM orders UNION ALL SELECT * REPLACE ('A' AS o_orderstatus) FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'")(lambda w: _published(w))
query("built_table", "o_custkey:i n:i", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")(
    lambda w: tables.build_table(w.spark, "leasewise_built", lambda: w.table("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))))
query("partition_upsert", "o_orderkey:i o_orderstatus:s o_custkey:i", """
    SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 10 <> 0 UNION ALL SELECT o_orderkey, 'X', o_custkey FROM orders WHERE o_orderkey % 10 = 0 AND o_orderstatus = 'P'
    UNION ALL SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderkey % 10 = 0 AND o_orderstatus <> 'P'""")(lambda w: _partitioned(w))

query("melt", "o_orderpriority:s status:s n:i", """
    SELECT o_orderpriority, status, n FROM (SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O, count(*) FILTER (WHERE o_orderstatus = 'P') AS P
    FROM orders GROUP BY 1) UNPIVOT (n FOR status IN (F, O, P))""")(
    lambda w: w.table("orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().unpivot(["o_orderpriority"], ["F", "O", "P"], "status", "n"))
query("sheet_body", "row:i order_id:s code:s", "SELECT o_orderkey AS row, CAST(o_orderkey AS VARCHAR) AS order_id, o_orderpriority AS code FROM orders WHERE o_orderkey >= 3 AND o_orderstatus <> 'P'")(lambda w: _sheet(w))


def _text_orders(w):
    return w.spark.sql(f"SELECT {_TEXT} FROM {{t}}", t=w.table("orders"))


def _sheet(w):
    from ..sources.landing import clean_sheet
    marked = w.table("orders").select(F.col("o_orderkey").alias("row"), F.when(F.col("o_orderstatus") == "P", "marker row").otherwise(F.col("o_orderkey").cast("string")).alias("c0"), "o_custkey", F.col("o_orderpriority").alias("c2"))
    return clean_sheet(marked, "row", 3, ["marker row"], {"order_id": 0, "code": 2})


def _roles(w):
    place = lambda a, t: F.struct(F.concat(F.lit("a"), (F.col("o_custkey") % a).cast("string")).alias("id"), F.concat(F.lit("town "), (F.col("o_orderkey") % t).cast("string")).alias("town"))
    return w.table("orders").select("o_orderkey", place(50, 9).alias("billing"), F.when(F.col("o_orderstatus") != "O", place(70, 11)).alias("shipping"))


def _statuses(w):
    events = w.table("events").select("event_id", "user_id", F.when(F.col("event_type") == "view", "success").when(F.col("event_type") == "error", "fail").alias("status"))
    good, bad = incremental.split_status(events)
    return good.withColumn("outcome", F.lit("good")).unionByName(bad.withColumn("outcome", F.lit("bad")))


def _row_counts(w):
    found = [(n, quality.check_row_count(w.table(n), 100), quality.check_row_count(w.table(n), 1, 500)) for n in ("orders", "nation")]
    return w.spark.createDataFrame(found, "table_name string, enough boolean, in_bounds boolean")


def _calendar_fill(w):
    made = w.table("orders").select(F.col("o_orderdate").cast("date").alias("date"), (F.col("o_orderkey") % 3).cast("int").alias("ordinal"), "o_orderkey")
    grid = calendar.day_spine(w.spark, SETTINGS.first_day, SETTINGS.as_of).withColumn("ordinal", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    kept = grid.join(calendar.number_spine(w.spark, 3), "ordinal", "left_semi")
    return kept.join(made, ["date", "ordinal"], "left").groupBy("date", "ordinal").agg(F.count("o_orderkey").alias("orders"))


def _retention(w):
    """Orders per month as the text of a cohort sheet, under its heading."""
    share = lambda k: F.concat(F.count_if(F.col("o_custkey") % k == 0).cast("string"), F.lit("%"))
    body = w.table("orders").groupBy(F.trunc("o_orderdate", "month").alias("b")).agg(
        F.format_number(F.count(F.lit(1)), 0).alias("a"), share(2).alias("c"), share(3).alias("d"), F.lit("").alias("e"))
    head = w.spark.createDataFrame([(1, "", "Existing customers engagement", *_MONTHS)], "row int, a string, b string, c string, d string, e string")
    return head.unionByName(body.select((F.months_between("b", F.lit("1990-01-01").cast("date")) + 2).cast("int").alias("row"), "a", F.col("b").cast("string").alias("b"), "c", "d", "e"))


def _folder(w, name):
    return f"{checkpoint_dir(w.spark)}/round-trips/{name}-{uuid.uuid4().hex}"


def _landed(w):
    from ..sources.landing import read_landing, write_landing
    path = _folder(w, "landing")
    orders = w.table("orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)"), F.col("o_orderdate").cast("date"), F.col("o_orderpriority").alias("o_clerk"))
    write_landing(orders, path)
    return read_landing(w.spark, path, TableSpec.of({"o_orderkey": "bigint", "o_totalprice": "numeric", "o_orderdate": "date", "o_clerk": "varchar(8)"}))[0]


def _csv(w):
    from ..sources.landing import read_seed, write_csv
    path = _folder(w, "csv")
    note = F.concat("c_mktsegment", F.lit(', "'), F.col("c_nationkey").cast("string"), F.lit('"'))
    write_csv(w.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), note.alias("note")), path, header=True)
    return read_seed(w.spark, path, {"id": "bigint"})


def _quoted(w):
    from ..sources.landing import write_csv
    path = _folder(w, "quoted")
    write_csv(w.table("customer").select("c_custkey", "c_name", F.concat(F.lit('"'), "c_mktsegment", F.lit('"')), "c_nationkey"), path, quote_text=True)
    return w.spark.read.text(path)


def _refreshed(w):
    """Depreciation built from the assets and rentals of all but the latest ones, then brought up to date."""
    c = SETTINGS
    last = w.rentals.agg(F.max("delivery_date")).first()[0]
    table = daytables.DayTable(f"leasewise_depreciation_{w.spark.sparkContext.applicationId.replace('-', '_')}")
    w.spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    before = w.rentals.filter(F.col("delivery_date") < F.date_sub(F.lit(last), 180))
    old, new = (cut_lean(rentals.depreciation_spans(w.items, r)) for r in (before, w.rentals))
    rentals.build_depreciation(table, old, c.first_day, c.as_of)
    rentals.refresh_depreciation(table, old, new, c.first_day, c.as_of)
    return table.read(w.spark)


def _visitors(w):
    """Days from the bitmaps of hours."""
    ev = w.table("events")
    counted = {"visitors": "user_id", "buyers": F.when(F.col("event_type") == "purchase", F.col("user_id"))}
    hours = distinct.bitmaps(ev.withColumns({"hour": F.date_trunc("hour", "ts"), "kind": F.col("event_type")}), ["hour", "kind"], counted, distinct.dense_ids(ev, "user_id"), "user_id")
    return distinct.distinct_counts(cut(hours), [F.col("hour").cast("date").alias("day"), "kind"], list(counted))


def _published(w):
    tables.publish(w.table("orders"), "leasewise_published", ["o_orderstatus"], [lambda df: quality.check_row_count(df, 1)])
    return tables.append(w.table("orders").filter("o_orderdate >= timestamp '2001-01-01'").withColumn("o_orderstatus", F.lit("A")), "leasewise_published")


def _keyed(w, name, key, partition_by=()):
    """A keyed table of this application, made anew."""
    table = tables.KeyedTable(f"leasewise_{name}_{w.spark.sparkContext.applicationId.replace('-', '_')}", (key,), 8, partition_by)
    w.spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    return table


def _partitioned(w):
    table = _keyed(w, "by_status", "o_orderkey", ("o_orderstatus",))
    orders = w.table("orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    table.create(orders)
    return table.merge(orders.filter("o_orderkey % 10 = 0 and o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("X")))


def _routed_window(w):
    table = _keyed(w, "by_customer", "o_custkey")
    table.create(_old(w))
    return table.merge(_new(w))
