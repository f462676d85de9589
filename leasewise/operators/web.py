"""Web activity: sessions, visitors, channels and the reports built on them.

An event row has: id, anonymous_id, user_id, master_user_id, timestamp,
src_tbl (name of the event table), url, referrer, context_* columns, email,
product_id.  `enrich_sessions` writes the web-activity fact, on which the
reports at the end of the module run; write it once and read it for those.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions.exprs import (
    after_parameter, before, epoch_second, first_match, like_any, page_handle,
    url_parameter, url_path, week_of,
)
from .identity import STORE, TRACKER, ids_of, resolve_actor
from .ordered import (
    CHUNK_ROWS, HOT_ROWS, before_chunk, first_rows, first_value, last_value, lookup, solid_keys, split_hot,
)

CAMPAIGN = ("name", "content", "source", "medium")


# --- sessions --------------------------------------------------------------

def sessionize(events: DataFrame, actor: str, ts: str, event_id: str, gap_s: int = 1800,
               hot_rows: int = HOT_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add session_id: the id of the first event of the session.

    A session starts at the actor's first event and after a pause of more
    than `gap_s`, counted in second boundaries.  Events without a time come
    after all others and open no session there; those without an actor are
    one actor's.  An actor with few events takes one window.  A hot one (a bot,
    or no actor) is cut into chunks; each is folded to its first event, its
    first and last second and the last session begun in it, and the open
    session is carried along these rows.
    """
    ev, (who,) = solid_keys(events, actor)
    ev = ev.withColumn("_sec", epoch_second(ts))
    order = [F.col(ts).asc_nulls_last(), F.col(event_id)]
    cold, hot = split_hot(ev, [who], order, hot_rows, chunk_rows)

    def opened(rows: DataFrame, *by: str) -> DataFrame:
        """`_head`: the first event of the window; `_own`: the event that opened the session, where it lies in the window."""
        w = Window.partitionBy(*by).orderBy(*order)
        pause = F.col("_sec") - F.lag("_sec").over(w) > gap_s
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn("_cut", F.when(pause, F.col(event_id))).select(
            "*", F.first(event_id).over(upto).alias("_head"), F.last("_cut", ignorenulls=True).over(upto).alias("_own"))

    out = opened(cold, who).withColumn("session_id", F.coalesce("_own", "_head")).drop("_cut", "_head", "_own")
    if hot is not None:
        marked = opened(hot, who, "_chunk")
        place = F.struct(F.col(ts).isNull(), ts, event_id)
        folded = marked.groupBy(who, "_chunk").agg(
            F.min("_sec").alias("_from"), F.max("_sec").alias("_to"), F.min_by(event_id, place).alias("_head"),
            F.max_by("_cut", F.when(F.col("_cut").isNotNull(), place)).alias("_tail"))
        along, earlier, _ = before_chunk([who])
        pause = F.col("_from") - F.last("_to", ignorenulls=True).over(earlier)
        begins = F.row_number().over(along) == 1
        carried = (
            folded.withColumn("_open", F.when(begins | (pause > gap_s), F.col("_head")))
            .withColumn("_latest", F.coalesce("_tail", "_open"))
            .select(who, "_chunk", F.coalesce("_open", F.last("_latest", ignorenulls=True).over(earlier)).alias("_carried")))
        placed = marked.join(carried, [who, "_chunk"]).withColumn("session_id", F.coalesce("_own", "_carried"))
        out = out.unionByName(placed.drop("_chunk", "_cut", "_head", "_own", "_carried"))
    return out.drop(who, "_sec")


def session_table(sessioned: DataFrame, actor: str, ts: str, event_id: str, kind: str) -> DataFrame:
    """One row per session: start, end, events, first event kind, bounce."""
    return sessioned.groupBy("session_id").agg(
        F.min(actor).alias(actor), F.min(ts).alias("session_start_ts"), F.max(ts).alias("session_end_ts"),
        F.count(F.lit(1)).alias("event_count"), first_value(kind, ts, event_id).alias("first_kind"),
    ).withColumn("is_bounce", F.col("event_count") == 1)


# --- per-event attributes --------------------------------------------------

DEVICES = {"%iphone%": "iPhone", "%android%": "Android", "%ipad%": "iPad"}


def device_class(agent: str | Column) -> Column:
    agent = F.col(agent) if isinstance(agent, str) else agent
    rules = [(agent.ilike(p), name) for p, name in DEVICES.items()]
    return first_match([*rules, (agent.isNotNull(), "PC")])


def flag_internal(events: DataFrame, exclusions: DataFrame, email_patterns: Sequence[str] = ()) -> DataFrame:
    """Add is_internal from an exclusion table (kind, value) and e-mail patterns.

    kind is context_ip, email or anonymous_id.
    """
    out, hit = events, F.coalesce(like_any("email", email_patterns), F.lit(False))
    for kind in ("context_ip", "email", "anonymous_id"):
        listed = exclusions.filter(F.col("kind") == kind).select(
            F.col("value").alias(kind), F.lit(True).alias(f"_x_{kind}")).distinct()
        out = lookup(out, listed, kind, ["id"])
        hit = hit | F.coalesce(F.col(f"_x_{kind}"), F.lit(False))
    return out.withColumn("is_internal", hit).drop("_x_context_ip", "_x_email", "_x_anonymous_id")


# --- channel rules ---------------------------------------------------------

# Channel ids of the ordered classification rules.
REFERRER_CHANNELS = {
    "%google%": "google_search",
    "%bing%": "bing_search",
    "%facebook%": "facebook_organic",
    "%instagram%": "instagram_organic",
    "%shareasale%": "shareasale",
}


def classify_channel(df: DataFrame, sponsored: Mapping[str, str] | None = None,
                     own_site: str = "%shop.example.com%", name: str = "session_channel_id") -> DataFrame:
    """Channel of a session by ordered rules.

    Reads session_has_gclid, ad_channel_id, is_referral_session,
    session_campaign_source, session_campaign_medium, session_referrer.
    `sponsored` maps a campaign source to its channel id.
    """
    source, medium, referrer = (F.col(f"session_{c}") for c in ("campaign_source", "campaign_medium", "referrer"))
    clicked = F.col("session_has_gclid") == 1
    rules = [
        (clicked & F.col("ad_channel_id").isNotNull(), F.col("ad_channel_id")),
        (clicked, "adwords_search"),
        (F.col("is_referral_session") == 1, "referral"),
        (source.ilike("%facebook%") & (medium == "cpc") & referrer.ilike("%insta%"), "instagram_ads"),
        (source.ilike("%facebook%") & (medium == "cpc"), "facebook_ads"),
        *[(source == s, c) for s, c in (sponsored or {}).items()],
        ((source == "liveintent") & (medium == "cpc"), "liveintent"),
        *[(referrer.ilike(p), c) for p, c in REFERRER_CHANNELS.items()],
        (referrer.ilike(own_site), "internal"),
    ]
    return df.withColumn(name, first_match(rules, "direct"))


def module_flags(modules: Mapping[str, str], home: str, parameter: str = "pf_c_collection") -> list[Column]:
    """Aggregates per visitor: came to collection X from the home page."""
    value = after_parameter("url", parameter)
    return [
        F.coalesce(F.max(F.when((value == c) & (F.col("context_page_referrer") == home), 1)), F.lit(0))
        .alias(f"is_{name}_module") for name, c in modules.items()
    ]


def touch_attributes(df: DataFrame, actor: str, ts: str, event_id: str, columns: Sequence[str]) -> DataFrame:
    """First and last value of each column per actor, nulls included."""
    order = F.struct(ts, event_id)
    firsts = [F.min_by(c, order).alias(f"user_first_{c}") for c in columns]
    lasts = [F.max_by(c, order).alias(f"user_last_{c}") for c in columns]
    return df.groupBy(actor).agg(*firsts, *lasts)


def session_attributes(events: DataFrame, dev_site: str = "%-dev.%", extra: Sequence[Column] = ()) -> DataFrame:
    """One row per session: campaign, referrer, click id, flags, bounds, pages.

    The reference needs a window per attribute; one aggregate gives them all.
    extra: further aggregates over the events of a session.
    """
    order = F.struct("timestamp", "id")
    firsts = [first_value(f"context_campaign_{c}", "timestamp", "id").alias(f"session_campaign_{c}") for c in CAMPAIGN]
    has = lambda p: F.coalesce(F.max(F.when(F.col("url").ilike(p), 1)), F.lit(0))
    return events.groupBy("session_id").agg(
        F.min("master_user_id").alias("master_user_id"), *firsts,
        F.min_by("referrer", order).alias("session_referrer"),
        has("%gclid%").alias("session_has_gclid"),
        first_value(url_parameter("url", "gclid"), "timestamp", "id").alias("session_gcl_id"),
        has("%source=referral%").alias("is_referral_session"),
        F.min("timestamp").alias("session_start_ts"), F.max("timestamp").alias("session_end_ts"),
        has(dev_site).alias("is_dev_session"),
        F.count_if(F.col("src_tbl") == "pages").alias("session_page_views"),
        before(first_value("url", "timestamp", "id"), "?").alias("session_first_url"), *extra,
    ).withColumn("is_bounce_session", F.col("session_page_views") == 1)


def enrich_sessions(sessioned: DataFrame, idmap: DataFrame, members: DataFrame, products: DataFrame,
                    campaigns: DataFrame, clicks: DataFrame, geo: DataFrame, exclusions: DataFrame,
                    email_patterns: Sequence[str] = (), sponsored: Mapping[str, str] | None = None,
                    modules: Mapping[str, str] | None = None, own_site: str = "shop.example.com",
                    dev_site: str = "%-dev.%", untracked: str = "%little%") -> DataFrame:
    """The web-activity fact: one row per event of a non-development session.

    members: member_id, membership_start_dt.  clicks: gcl_id, campaign_id.
    campaigns: campaign_id, src_campaign_id, channel_id.  geo: ip_id, region,
    country, city.  Lookups are reduced to one row per key, so the fact keeps
    the grain of the events.
    """
    # Ad campaign of a click id.
    by_click = first_rows(clicks.select("gcl_id", "campaign_id"), "gcl_id", ["campaign_id"])
    paid = campaigns.filter(F.col("channel_id").isin("adwords_search", "adwords_display")).select(
        F.col("src_campaign_id").alias("campaign_id"), F.col("campaign_id").alias("ad_campaign_id"),
        F.col("channel_id").alias("ad_channel_id"))
    by_click = by_click.join(first_rows(paid, "campaign_id", ["ad_campaign_id"]), "campaign_id").select(
        F.col("gcl_id").alias("session_gcl_id"), "ad_campaign_id", "ad_channel_id")

    # Sessions are aggregated from the events as they come in, visitors from
    # the sessions.  Only the first visit counts development sessions.
    flags = module_flags(modules or {}, f"https://{own_site}/")
    device = device_class("context_user_agent")
    seen = F.min(F.when(device.isNotNull(), F.struct(F.col("timestamp"), F.col("id"), device.alias("device")))).alias("_device")
    every = session_attributes(sessioned, dev_site, [seen, *flags])
    kept = F.col("is_dev_session") == 0
    names = [f"is_{name}_module" for name in modules or {}]
    visitors = every.groupBy("master_user_id").agg(
        F.min("session_start_ts").alias("user_first_visit_ts"), F.min(F.when(kept, F.col("_device")))["device"].alias("session_device_type"),
        *[F.coalesce(F.max(F.when(kept, F.col(n))), F.lit(0)).alias(n) for n in names])
    sessions = classify_channel(
        lookup(every.filter(kept).drop("_device", *names), by_click, "session_gcl_id"), sponsored, f"%{own_site}%")
    touched = [f"session_{c}" for c in ("channel_id", *[f"campaign_{c}" for c in CAMPAIGN])]
    touches = touch_attributes(sessions, "master_user_id", "session_start_ts", "session_id", touched)
    visitors = visitors.join(touches, "master_user_id", "left")

    # Member: by store account first, then by the resolved actor itself.
    starts = members.select("member_id", "membership_start_dt")
    by_store = ids_of(idmap, STORE, "master_user_id", "_mapped").join(
        starts.withColumnRenamed("member_id", "_mapped"), "_mapped"
    ).select("master_user_id", F.col("_mapped").alias("member_id"), "membership_start_dt", F.lit(1).alias("_rank"))
    direct = starts.select(F.col("member_id").alias("master_user_id"), "member_id", "membership_start_dt", F.lit(2).alias("_rank"))
    known = first_rows(by_store.unionByName(direct), "master_user_id", ["_rank"]).drop("_rank")
    visitors = visitors.join(known, "master_user_id", "left")

    out = lookup(sessioned.join(sessions.drop("master_user_id"), "session_id"), visitors, "master_user_id", ["id"])
    existing = F.col("timestamp").cast("date") > F.date_add(F.col("membership_start_dt").cast("date"), 1)
    out = (
        out.withColumn("membership_state", F.when(existing, "existing").otherwise("new")).drop("membership_start_dt")
        .withColumn("is_client_trackable", ~F.col("anonymous_id").ilike(untracked))
        .withColumn("product_name", page_handle("url"))
        .withColumn("device_type", device_class("context_user_agent"))
    )
    out = flag_internal(out, exclusions, email_patterns)

    # Product by page handle, social campaign by name, place by address.
    by_handle = products.select(F.lower(F.trim("handle")).alias("_handle"), F.col("id").alias("_product"))
    out = lookup(out.withColumn("_handle", F.lower(F.trim("product_name"))),
                 first_rows(by_handle, "_handle", ["_product"]), "_handle", ["id"])
    social = campaigns.filter("channel_id = 'facebook_ads'").select(
        F.col("src_campaign_id").alias("context_campaign_name"), F.col("campaign_id").alias("_social"))
    out = lookup(out, first_rows(social, "context_campaign_name", ["_social"]), "context_campaign_name", ["id"])
    places = geo.select(F.col("ip_id").alias("context_ip"), F.col("region").alias("ip_region"),
                        F.col("country").alias("ip_country"), F.col("city").alias("ip_city"))
    out = lookup(out, first_rows(places, "context_ip", ["ip_region", "ip_city"]), "context_ip", ["id"])
    paid_social = (F.lower("context_campaign_source") == "facebook") & F.col("_social").isNotNull()
    return (
        out.withColumn("product_id_master", F.coalesce("product_id", "_product"))
        .withColumn("campaign_id", F.when(paid_social, F.col("_social")).otherwise(F.col("ad_campaign_id")))
        .drop("_handle", "_product", "_social", "ad_campaign_id", "ad_channel_id")
    )


# --- reports on the web-activity fact --------------------------------------

def session_flags(web: DataFrame, **kinds: str) -> DataFrame:
    """Per external session: 1/0 for each named event table."""
    seen = [F.max(F.when(F.col("src_tbl") == v, 1).otherwise(0)).alias(k) for k, v in kinds.items()]
    return web.filter(~F.col("is_internal")).groupBy("session_id").agg(*seen)


def _product_events(web: DataFrame, products: DataFrame, kind: str) -> DataFrame:
    named = products.select(F.col("sku").alias("product_id"), "product_name")
    return web.filter(F.col("src_tbl") == kind).drop("product_name").join(named, "product_id").select(
        "product_name", F.col("product_id").alias("sku"), "timestamp", "session_start_ts",
        F.col("master_user_id").alias("user_id"), "url", "session_id",
        "user_first_session_channel_id", "session_channel_id")


def abandoned_cart(web: DataFrame, products: DataFrame) -> DataFrame:
    """Products added in external sessions that began but never finished checkout."""
    lost = session_flags(web, started="checkout_started", done="order_completed").filter("started = 1 and done = 0")
    return _product_events(web, products, "product_added").join(lost.select("session_id"), "session_id", "left_semi")


def product_view_mix(web: DataFrame, products: DataFrame) -> DataFrame:
    """Products viewed in external sessions that did not start checkout."""
    lost = session_flags(web, viewed="product_viewed", started="checkout_started").filter("viewed = 1 and started = 0")
    return _product_events(web, products, "product_viewed").join(lost.select("session_id"), "session_id", "left_semi")


def checkout_loss(web: DataFrame) -> DataFrame:
    """Where new visitors' abandoning sessions ended."""
    lost = session_flags(web, started="checkout_started", done="order_completed").filter("started = 1 and done = 0")
    ev = web.join(lost.select("session_id"), "session_id", "left_semi")
    step = lambda name: F.when(F.col("src_tbl") == name, F.col("timestamp"))
    return ev.groupBy("session_id", "session_start_ts").agg(
        before(last_value("url", "timestamp", "id"), "?").alias("final_url"),
        F.max(F.when(F.col("membership_state") == "new", step("checkout_step_viewed"))).alias("last_checkout_step_viewed_ts"),
        F.max(F.when(F.col("membership_state") == "new", step("checkout_step_completed"))).alias("last_checkout_step_completed_ts"),
        F.max(F.when(F.col("membership_state") == "new", F.col("timestamp"))).alias("last_step_ts"),
        F.count_if((F.col("membership_state") == "new") & (F.col("src_tbl") == "checkout_step_completed")).alias("checkout_steps_completed"),
    ).filter("last_step_ts is not null")


def page_views(web: DataFrame, own_site: str = "shop") -> DataFrame:
    """Per event: session, product, day, own-site referral, member's page views."""
    views = web.filter("src_tbl = 'pages' and member_id is not null").groupBy("member_id").agg(
        F.count(F.lit(1)).alias("page_views"))
    return lookup(web, views, "member_id", ["session_id"]).select(
        "member_id", "session_id", "product_id_master", F.col("created_at").cast("date").alias("created_at"),
        F.coalesce(F.col("referrer").contains(own_site), F.lit(False)).alias("own_referred"), "page_views")


def registry_agg(web: DataFrame, members: DataFrame) -> DataFrame:
    """Registry activity per owner who created one, with a later-order flag."""
    kind, ts = F.col("src_tbl"), F.col("timestamp")
    at = lambda name: F.when(kind == name, ts)
    base = web.withColumn("user_id", F.coalesce("registry_customer_id", "user_id")).groupBy("user_id", "member_id").agg(
        F.min(at("add_to_registry_product_added")).alias("registry_creation_ts"),
        F.max(F.when(kind.ilike("%registry%"), ts)).alias("last_registry_activity_ts"),
        F.min(at("registry_registry_viewed")).alias("first_registry_view_ts"),
        F.max(at("registry_registry_viewed")).alias("last_registry_view_ts"),
        F.sum(F.when(kind == "registry_registry_viewed", 1)).alias("total_registry_views"),
        F.min(at("registry_checkout_started")).alias("first_registry_checkout_ts"),
        F.max(at("registry_checkout_started")).alias("last_registry_checkout_ts"),
        F.sum(F.when(kind == "registry_checkout_started", 1)).alias("total_registry_checkouts"))
    buyers = web.filter("src_tbl = 'order_completed'").select("user_id").distinct().withColumn("_bought", F.lit(1))
    ordered = (
        base.filter("first_registry_checkout_ts is not null").select("user_id").distinct()
        .join(buyers, "user_id", "left").select("user_id", F.coalesce("_bought", F.lit(0)).alias("order_completed")))
    names = members.select("member_id", "first_name", "last_initial", "hubspot_customer_id")
    created = base.filter("registry_creation_ts is not null")
    return lookup(lookup(created, names, "member_id"), ordered, "user_id")


def registry_pairs(line_items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Buyer and recipient of each registry line.

    `properties` is a JSON array of {name, value}, where the value of the
    registry entry is itself JSON text holding registrantId.
    """
    from ..functions.exprs import email_key, json_rows, json_text
    entries = F.transform(json_rows("properties", "name string, value string"), lambda e: json_text(e["value"], "registrantId"))
    lines = line_items.filter("fulfillment_service = 'registry'").select(
        F.col("id").alias("line_item_id"), "order_id", "price", "product_id", "variant_id",
        F.try_element_at(F.filter(entries, lambda v: v.isNotNull()), F.lit(1)).alias("recipient_shopify_id"))
    buyers = orders.select(F.col("id").alias("order_id"), json_text("customer", "id").alias("customer_shopify_id"))

    def role(name):
        return customers.select(F.col("id").alias(f"{name}_shopify_id"), email_key("email").alias(f"{name}_member_id"),
                                F.col("email").alias(f"{name}_email"))

    out = lines.join(buyers, "order_id")
    out = lookup(out, role("customer"), "customer_shopify_id")
    return lookup(out, role("recipient"), "recipient_shopify_id")


def first_page_share(web: DataFrame, folder: str = "products/") -> DataFrame:
    """Weekly share of sessions whose first page is a product page."""
    sessions = web.filter("src_tbl = 'pages'").groupBy("session_id", "session_start_ts").agg(
        F.min_by("url", F.struct("timestamp", "id")).alias("first_url"))
    on_product = F.coalesce(F.col("first_url").ilike(f"%{folder}%"), F.lit(False)).cast("int")
    return sessions.groupBy(week_of("session_start_ts").alias("week")).agg(
        F.avg(on_product).alias("direct_to_product_pct"))


def pre_post(web: DataFrame, tracker: DataFrame, idmap: DataFrame, days: int = 30) -> DataFrame:
    """Activity per day and page, `days` either side of the page's go-live.

    tracker: product, url, live_date; one row per changed page.
    """
    ids = ids_of(idmap, TRACKER, "anonymous_id", "_mapped")
    who = F.coalesce("member_id", "_mapped", "anonymous_id", "user_id")
    needed = web.select("id", "session_id", "timestamp", "src_tbl", "url", "member_id", "anonymous_id", "user_id")
    named = lambda rows: lookup(rows, ids, "anonymous_id", ["id"]).withColumn("_who", who)
    # Pages and days are cut before any lookup; buyers come from order events only.
    live = tracker.select("product", url_path("url").alias("page"), F.col("live_date").cast("date").alias("go_live_date"))
    at = F.col("timestamp").cast("timestamp")
    near = needed.withColumn("page", url_path("url")).join(live, "page").filter(
        (at >= F.date_sub("go_live_date", days).cast("timestamp"))
        & (at <= F.date_add("go_live_date", days).cast("timestamp")))
    orders = named(needed.filter("src_tbl = 'order_completed'")).groupBy("session_id").agg(
        F.min_by("_who", F.struct("timestamp", "id")).alias("_buyer"))
    # One row per session and visitor of a page and day before anything is counted.
    keys = ["go_live_date", "event_date", "product", "page"]
    visits = named(near).withColumn("event_date", F.col("timestamp").cast("date")).groupBy(*keys, "session_id", "_who").agg(
        F.max(F.when(F.col("src_tbl") == "product_added", 1)).alias("_added"))
    return lookup(visits, orders, "session_id").groupBy(*keys).agg(
        F.countDistinct("session_id").alias("distinct_sessions"), F.countDistinct("_who").alias("distinct_members"),
        F.countDistinct(F.when(F.col("_added") == 1, F.col("session_id"))).alias("num_add_to_cart_events"),
        F.countDistinct("_buyer").alias("num_orders_completed"),
    ).withColumn("period", F.when(F.col("event_date") < F.col("go_live_date"), "PRE").otherwise("POST"))


def web_activity(events: DataFrame, idmap: DataFrame, gap_s: int = 1800, **inputs) -> DataFrame:
    """Actor, session and enrichment in one go; see `enrich_sessions`."""
    known = resolve_actor(events, idmap)
    return enrich_sessions(sessionize(known, "master_user_id", "timestamp", "id", gap_s), idmap, **inputs)
