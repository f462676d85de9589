"""Members: payments, type, status, membership and the feeds built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import day
from ..functions.exprs import (
    MONEY, blank_to_null, first_match, flag, json_text, like_any, open_end, parse_timestamp,
)
from .commerce import RENEWAL, is_membership_name, name_list
from .identity import CRM, STORE, ids_of
from .ordered import first_rows, first_value, lookup

# Plan prices and days of grace after a payment.
ANNUAL, MONTHLY, PER_ITEM = "annual", "monthly", "per-item"
PLAN_PRICES = {ANNUAL: 149, MONTHLY: 18}
GRACE_DAYS = {ANNUAL: 370, MONTHLY: 35}
FLAGSHIP = "FLAGSHIP_GROUP"

OPS_STATES = (("SF", ("%ca%",)), ("NYC", ("%ny%", "%new%", "%connecticut%")))


# Columns of `settled` that the payments below read.
SETTLED = ("member_id", "line_item_id", "transaction_ts", "sales_type", "product_name", "sku", "quantity", "gross_sales")


def settled(ledger: DataFrame) -> DataFrame:
    """Latest row per (order, line, |quantity|) when its net is not negative.

    A refund has the absolute quantity of the line it undoes, so the pair is
    dropped and an earlier payment of the member counts as the last one.
    """
    keyed = ledger.withColumn("_units", F.abs("quantity"))
    order = [F.col("transaction_ts").desc_nulls_first(), F.col("net_sales").asc_nulls_last(),
             F.col("sales_type").desc(), F.col("sku").asc_nulls_last()]
    return first_rows(keyed, ["order_id", "line_item_id", "_units"], order).drop("_units").filter("net_sales >= 0")


def payment_agg(ledger: DataFrame, as_of: date | str, days: int = 35, last: DataFrame | None = None) -> DataFrame:
    """First and last payment per plan type, by product name, per member.

    last: `settled` rows of the ledger, where these are written already.
    """
    plan = like_any("product_name", ("%member%", "%plan"))
    kinds = {"month": "%month%", "annual": "%annual%", "per_item": "%per%item%"}
    ts, aggs = F.col("transaction_ts"), []
    for name, pattern in kinds.items():
        hit = F.when(F.col("product_name").ilike(pattern) & plan, ts)
        aggs += [F.min(hit).alias(f"min_{name}_payment_ts"), F.max(hit).alias(f"max_{name}_payment_ts")]
    recent = ts >= F.date_sub(day(as_of), days)
    return (settled(ledger) if last is None else last).groupBy("member_id").agg(
        *aggs, F.max(F.when(~plan, ts)).alias("max_product_payment_ts"),
        F.countDistinct(F.when(recent & ~plan, F.col("sku"))).alias("active_sku_ct"))


def billing_type() -> Column:
    """Plan of the latest plan payment; per-item only without the others."""
    annual, monthly = F.col("max_annual_payment_ts"), F.col("max_month_payment_ts")
    return first_match([
        (annual.isNotNull() & monthly.isNotNull(), F.when(annual >= monthly, ANNUAL).otherwise(MONTHLY)),
        (annual.isNotNull(), ANNUAL), (monthly.isNotNull(), MONTHLY),
        (F.col("max_per_item_payment_ts").isNotNull(), PER_ITEM)])


def flagship_skus(products: DataFrame, pattern: str) -> DataFrame:
    """Variants of the flagship product, treated as one SKU below."""
    return products.filter(F.col("product_name").ilike(pattern)).select("sku", F.lit(FLAGSHIP).alias("_group")).distinct()


def payment_inputs(ledger: DataFrame, lines: DataFrame, variants: DataFrame, flagship: DataFrame,
                   influencers: DataFrame, special: DataFrame, as_of: date | str, days: int = 35, last: DataFrame | None = None) -> DataFrame:
    """Payment side of the lifecycle inputs, one row per member; `last` as in `payment_agg`."""
    variant = lookup(lines.select("line_item_id", "variant_id"), variants.select(F.col("id").alias("variant_id"), F.col("title").alias("_variant")), "variant_id")
    marked = special.select("member_id").distinct().withColumn("_special", F.lit(True))
    name = F.col("product_name")
    replaces = (F.col("sales_type") == "return") & (F.col("quantity") == 0) & name.isNull() & (F.col("gross_sales") >= 80)
    # Names are read before the rows are dealt, so that only the answers go along.
    paid = (settled(ledger) if last is None else last).select(
        "member_id", "transaction_ts", "sku", "line_item_id", is_membership_name(name).alias("_named"), replaces.alias("_replaces"),
        F.when(name.ilike("%gift card%"), True).when(blank_to_null(name).isNotNull(), False).alias("is_gift_card"))
    variant = variant.select("line_item_id", F.coalesce(F.col("_variant").ilike("%month%"), F.lit(False)).alias("_registry"))
    paid = lookup(lookup(paid, variant, "line_item_id").drop("line_item_id"), flagship, "sku").withColumn("sku", F.coalesce("_group", "sku")).drop("_group")
    paid = lookup(paid, marked, "member_id")
    replaced = F.col("_special").isNotNull() & F.col("_replaces")
    paid = paid.select(
        "member_id", "transaction_ts", "sku", F.coalesce(F.col("_named") | replaced, replaced, F.lit(False)).alias("is_membership"),
        "is_gift_card", F.coalesce("_registry", F.lit(False)).alias("is_registry_product")).distinct()
    plan, ts = F.col("is_membership"), F.col("transaction_ts")
    recent = ts >= F.date_sub(day(as_of), days)
    gift, registry = flag(F.col("is_gift_card")), flag(F.col("is_registry_product"))
    # One row per member and sku first: distinct skus are then plain sums.
    per_sku = paid.groupBy("member_id", "sku").agg(
        F.min(F.when(plan, ts)).alias("_first_plan"), F.max(F.when(plan, ts)).alias("_last_plan"), F.max(F.when(~plan, ts)).alias("_last_item"),
        F.max(F.when(~plan & recent, 1)).alias("_recent"), F.max(F.when(~plan, 1)).alias("_item"),
        F.sum(gift).alias("_gift"), F.count(gift).alias("_gifts"), F.sum(registry).alias("_registry"), F.count(registry).alias("_registries"))
    known = F.col("sku").isNotNull()
    stats = per_sku.groupBy("member_id").agg(
        F.min("_first_plan").alias("first_membership_purchase_ts"), F.max("_last_plan").alias("last_membership_payment_ts"),
        F.max("_last_item").alias("last_product_payment_ts"),
        F.count_if(known & (F.col("_recent") == 1)).alias("ct_active_product_payments"), F.count_if(known & (F.col("_item") == 1)).alias("ct_purchased_skus"),
        F.max(flag(F.col("sku") == FLAGSHIP)).alias("is_ever_purchased_flagship"),
        F.try_divide(F.sum("_gift"), F.sum("_gifts")).alias("avg_purchased_gift_card"),
        F.try_divide(F.sum("_registry"), F.sum("_registries")).alias("avg_purchased_registry_product"))
    named = influencers.select("member_id").distinct().withColumn("is_influencer", F.lit(1))
    return stats.join(named, "member_id", "left").withColumn("is_influencer", F.coalesce("is_influencer", F.lit(0)))


def rental_inputs(rentals: DataFrame, flagship: DataFrame, as_of: date | str) -> DataFrame:
    """Rental side of the lifecycle inputs, one row per member."""
    today = day(as_of)
    out, back = F.col("delivery_date"), F.col("pick_up_date")
    items = lookup(rentals.select("member_id", "sku", "delivery_date", "pick_up_date"), flagship, "sku").withColumn("sku", F.coalesce("_group", "sku"))
    tests = {
        "ct_active_products": (out <= today) & (back.isNull() | (back >= today)), "ct_items_with_scheduled_delivery": out > today,
        "ct_items_with_scheduled_pickup": back > today, "ct_skus_delivered": out <= today}
    # One row per member and sku first: distinct skus are then plain sums.
    per_sku = items.groupBy("member_id", "sku").agg(*[F.max(F.when(t, 1)).alias(n) for n, t in tests.items()], F.min("delivery_date").alias("_first"))
    return per_sku.groupBy("member_id").agg(
        *[F.count_if(F.col("sku").isNotNull() & (F.col(n) == 1)).alias(n) for n in tests],
        F.min(F.when(F.col("sku") == FLAGSHIP, 1).otherwise(0)).alias("is_only_flagship_rented"),
        F.min("_first").alias("first_delivery_date"))


def lifecycle_inputs(payments: DataFrame, rentals: DataFrame) -> DataFrame:
    """Payment and rental inputs of every member that has either."""
    both = payments.join(rentals, "member_id", "full_outer")
    return both.withColumn("is_only_flagship_paid", flag(
        (F.col("is_ever_purchased_flagship") == 1) & (F.col("ct_purchased_skus") == 1)))


# --- rules -----------------------------------------------------------------

def membership_type(as_of: date | str) -> Column:
    """Ordered rules for the type of membership.

    Reads is_special, the inputs of `lifecycle_inputs`, membership_start_dt,
    billing_membership_type, crm_membership_type, membership_product_name and
    crm_membership_date.
    """
    waiting = F.coalesce("membership_start_dt", open_end()) > day(as_of)
    return first_match([
        (F.col("is_special"), ANNUAL),
        (F.col("is_influencer") == 1, "influencer"),
        (F.col("avg_purchased_gift_card") == 1, "gift-card-buyer"),
        (F.col("avg_purchased_registry_product") == 1, "registry-product-buyer"),
        (waiting & (F.col("ct_active_product_payments") > 0), PER_ITEM),
        (waiting, "lead"),
        (F.col("billing_membership_type").isNotNull(), F.col("billing_membership_type")),
        (F.col("crm_membership_type").ilike("%item%") | F.col("membership_product_name").ilike("%item%"), PER_ITEM),
        (F.col("crm_membership_date").isNotNull() | blank_to_null("crm_membership_type").isNotNull(), PER_ITEM),
    ], "lead")


# Case number -> status, sub-status, detail.
STATUS_LABELS = {
    1: ("Pre Active", "Unscheduled", "Pre Active - Unscheduled"),
    2: ("Pre Active", "Scheduled", "Pre Active - Scheduled"),
    3: ("Active", "Engaged", "Multiple Items"),
    4: ("Active", "Engaged", "Growing basket"),
    5: ("Active", "1 Item only", "Growing basket"),
    6: ("Active", "1 Item only", "Maintaining"),
    7: ("Active", "Re-engaging", "No active items, but active membership"),
    8: ("Active", "At Risk", "Pickups scheduled"),
    9: ("Active", "Churn Pending", "Payments Stopped"),
    10: ("Active", "Churn Pending", "Pickups made"),
    11: ("Churned", "Churned", "Churned"),
    12: ("Active", "At Risk", "Flagship only >3mo"),
}


def member_status(df: DataFrame, as_of: date | str) -> DataFrame:
    """Add status_case, member_status, member_sub_status, member_status_detail.

    Six named tests on payments and four counts feed an ordered rule list.
    Null payment dates make a test null, not false, and a null rule does not
    match; that keeps a member who never paid from counting as lapsed.
    """
    today, kind = day(as_of), F.col("membership_type")
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    d, p = count("ct_items_with_scheduled_delivery"), count("ct_items_with_scheduled_pickup")
    a, m = count("ct_active_products"), count("ct_skus_delivered")

    def paid(column, newer):
        bound = {k: F.date_sub(today, n) for k, n in GRACE_DAYS.items()}
        value = F.col(column)
        tests = [((value >= b) if newer else (value <= b)) & (kind == k) for k, b in bound.items()]
        return reduce(lambda x, y: x | y, tests)

    fresh = paid("last_membership_payment_ts", True)
    stale = paid("last_membership_payment_ts", False)
    prod = paid("last_product_payment_ts", True)
    joined = (F.col("first_membership_purchase_ts").cast("date") <= today) | (kind == PER_ITEM)
    current = fresh | (kind == PER_ITEM) | (stale & prod)
    lapsed = ~((fresh & (kind != PER_ITEM)) | (stale & prod))
    live, kept = joined & current, a + d > p
    rules = [
        (joined & (d == 0) & (a == 0) & (m == 0), 1),
        (joined & (d > 0) & (a == 0) & (m == 0), 2),
        (live & (d - p <= 0) & (a > 1) & kept, 3),
        (live & (d - p > 0) & (a > 1) & kept, 4),
        (live & (d == p) & (a == 1) & kept & (F.col("is_only_flagship_rented") == 1)
         & (F.col("first_delivery_date") < F.date_sub(today, 90)), 12),
        (live & (d - p > 0) & (a == 1) & kept, 5),
        (live & ((d == 0) | (d == p)) & (a == 1) & ((p == 0) | (d == p)), 6),
        (live & (d > 0) & (a == 0) & (m > 0), 7),
        (joined & lapsed & (d - p <= 0) & (a > 0), 9),
        (live & (d == 0) & (a == p) & (a > 0), 8),
        ((kind != PER_ITEM) & (F.col("first_membership_purchase_ts").cast("date") < today) & current
         & (d == 0) & (a == 0) & (m > 0), 10),
        (joined & lapsed & (d == 0) & (a == 0), 11),
    ]
    out = df.withColumn("status_case", first_match(rules))
    names = ("member_status", "member_sub_status", "member_status_detail")
    return out.withColumns({
        name: first_match([(F.col("status_case") == case, labels[i]) for case, labels in STATUS_LABELS.items()])
        for i, name in enumerate(names)})


def membership_end() -> Column:
    """End of a churned membership: last payment plus grace, else last pickup."""
    churned, kind = F.col("member_status") == "Churned", F.col("membership_type")
    paid = F.col("last_membership_payment_ts").cast("date")
    return first_match([
        *[(churned & (kind == k), F.date_add(paid, n)) for k, n in GRACE_DAYS.items()],
        (churned, F.col("last_pickup_dt"))])


# --- member dimension ------------------------------------------------------

def contact_profile(contacts: DataFrame, idmap: DataFrame, exclude_emails: Sequence[str] = ()) -> DataFrame:
    """One preferred CRM contact per member, excluded addresses left out.

    Preferred: the contact whose e-mail key is the member id itself.
    youngest_child_dob is the latest birth date of the children.
    """
    ids = idmap.filter(F.col("src") == CRM).select(F.col("src_id").alias("id"), "email_key", "member_id")
    kept = contacts.filter("email is not null")
    if exclude_emails:
        kept = kept.filter(~like_any("email", exclude_emails))
    people = lookup(kept, ids, "id").withColumn("_own", F.coalesce(F.col("email_key") == F.col("member_id"), F.lit(False)))
    best = first_rows(people, "member_id", [F.col("_own").desc(), "id"])
    children = [F.col(f"child_{i}_dob") for i in (1, 2, 3)]
    crm_type = blank_to_null("membership_type")
    return best.select(
        "member_id", F.col("id").alias("crm_id"), "email", F.col("created_at").alias("contact_created_ts"),
        F.col("first_conversion_date").alias("first_conversion_ts"), "hs_analytics_source",
        F.col("hs_analytics_source_data_1").alias("hs_analytics_source_data"),
        F.col("membership_type").alias("crm_membership_type"),
        F.coalesce(parse_timestamp("hs_lifecyclestage_customer_date"),
                   F.when(crm_type.isNotNull(), F.col("created_at").cast("timestamp"))).alias("crm_membership_date"),
        F.col("firstname").alias("first_name"), F.col("lastname").alias("last_name"),
        *[f"child_{i}_dob" for i in (1, 2, 3)], F.greatest(*children).alias("youngest_child_dob"),
        sum((F.when(c.isNotNull(), 1).otherwise(0) for c in children), F.lit(0)).alias("number_of_children"),
        "expecting_at_sign_up", "city", "address", "zip", "state", "monthly_membership_end_date", "reason_for_canceling")


def shared_offer_members(orders: DataFrame, idmap: DataFrame, pattern: str) -> DataFrame:
    """Members who used a sharing code and when they first did."""
    used = orders.filter(F.col("discount_codes").ilike(pattern)).select(
        json_text("customer", "id").alias("_customer"), F.col("created_at").alias("_ts"))
    return lookup(used, ids_of(idmap, STORE, "_customer"), "_customer").filter("member_id is not null").groupBy(
        "member_id").agg(F.min("_ts").alias("shared_offer_ts"))


def dim_members(contacts: DataFrame, payments: DataFrame, inputs: DataFrame, orders: DataFrame, rentals: DataFrame,
                membership: DataFrame, special: DataFrame, overrides: DataFrame, shared: DataFrame, idmap: DataFrame,
                as_of: date | str, ops_states: Sequence[tuple[str, Sequence[str]]] = OPS_STATES) -> DataFrame:
    """One row per member: contact, start, type, status, end, dates, counts.

    contacts: `contact_profile`; payments: `payment_agg`; inputs:
    `lifecycle_inputs`; orders: order fact; membership: `membership_orders`;
    overrides: member_id, membership_first_purchase_dt, is_blacklist_member.
    Start is the earliest of override, plan payments, and for special and
    non-membership members their first item order; null when there is none.
    """
    placed = orders.filter(~F.col("is_gift_card_order") & (F.col("financial_status") != "refunded")).groupBy("member_id").agg(
        F.min(F.when(~F.col("is_membership_order"), F.col("order_ts"))).cast("date").alias("_item_dt"),
        F.min(F.when(F.col("is_membership_order"), F.col("order_ts"))).cast("date").alias("src_first_membership_order_dt"))
    trips = rentals.groupBy("member_id").agg(
        F.min(F.coalesce("delivery_date", open_end())).alias("_delivery"),
        F.max(F.coalesce("pick_up_date", open_end())).alias("_pickup"))
    known = F.nullif(F.col("_pickup"), open_end())
    plans = membership.select("member_id", "membership_product_name")
    marked = special.select("member_id").distinct().withColumn("_special", F.lit(True))
    forced = overrides.select("member_id", "membership_first_purchase_dt", "is_blacklist_member")
    # One row per member on every side: plain joins keep one partitioning.
    out = contacts
    for table in (payments, inputs, placed, trips, plans, marked, forced, shared):
        out = out.join(table, "member_id", "left")
    out = out.filter(F.coalesce("is_blacklist_member", F.lit(0)) != 1)
    item, open_ = F.col("_item_dt"), open_end()
    own_items = (F.col("ct_active_product_payments") > 0) & (F.col("avg_purchased_gift_card") < 1) & (F.col("avg_purchased_registry_product") < 1)
    dates = lambda *cs: F.nullif(F.least(*[F.coalesce(c, open_) for c in cs]), open_)
    override = F.col("membership_first_purchase_dt").cast("date")
    delivered = F.nullif(F.col("_delivery"), open_)
    out = out.withColumns({
        "is_special": F.coalesce("_special", F.lit(False)),
        "is_shared_offer": F.col("shared_offer_ts").isNotNull(),
        "membership_start_dt": dates(
            override, *[F.col(f"min_{k}_payment_ts").cast("date") for k in ("month", "annual", "per_item")],
            F.when(F.col("_special"), item), F.when(own_items, item)),
        "first_membership_order_dt": dates(override, item, delivered, F.col("src_first_membership_order_dt")),
        "first_item_order_dt": dates(item, delivered),
        "first_delivery_dt": delivered, "last_pick_up_dt": known, "last_pickup_dt": known,
        "billing_membership_type": billing_type(),
    })
    out = member_status(out.withColumn("membership_type", membership_type(as_of)), as_of)
    crm = idmap.filter(F.col("src") == CRM).groupBy("member_id").agg(F.max("src_id").alias("hubspot_customer_id"))
    out = out.join(crm, "member_id", "left")
    place = first_match([(like_any("state", ps), name) for name, ps in ops_states], "Other")
    return out.select(
        "member_id", "hubspot_customer_id", "email", "first_name", "last_name", F.substring("last_name", 1, 1).alias("last_initial"),
        "membership_start_dt", membership_end().alias("membership_end_dt"), "membership_type", "contact_created_ts",
        "hs_analytics_source", "hs_analytics_source_data", "child_1_dob", "child_2_dob", "child_3_dob", "youngest_child_dob",
        "number_of_children", "expecting_at_sign_up", "city", "address", "zip", "state", "is_shared_offer", "shared_offer_ts",
        "first_item_order_dt", "first_delivery_dt", "last_pick_up_dt", place.alias("ops_location"), "reason_for_canceling",
        "monthly_membership_end_date", "first_membership_purchase_ts", "last_membership_payment_ts", "last_product_payment_ts",
        "ct_active_product_payments", "ct_purchased_skus", "is_ever_purchased_flagship", "ct_active_products",
        "ct_items_with_scheduled_delivery", "ct_items_with_scheduled_pickup", "ct_skus_delivered", "is_only_flagship_rented",
        "first_delivery_date", "is_only_flagship_paid", "status_case", "member_status", "member_sub_status", "member_status_detail")


def dim_membership(members: DataFrame, as_of: date | str, prices: Mapping[str, int] = PLAN_PRICES) -> DataFrame:
    """Membership intervals begun by `as_of`; a null end is an open one."""
    today, end = day(as_of), F.col("membership_end_dt")
    price = first_match([(F.col("membership_type") == k, v) for k, v in prices.items()], 0)
    return members.filter(F.col("membership_start_dt") <= today).select(
        "member_id", F.col("membership_start_dt").alias("start_dt"), end.alias("end_dt"), "membership_type",
        F.when(end.isNull() | (end >= today), "active").otherwise("inactive").alias("status"),
        price.cast(MONEY).alias("price"))


# --- feeds and member aggregates -------------------------------------------

def customer_feed(members: DataFrame, rentals: DataFrame, registry: DataFrame, idmap: DataFrame,
                  as_of: date | str, inactive: str = "Churned") -> DataFrame:
    """CRM feed: next and latest delivery, status, dates, registry flag."""
    today = day(as_of)
    trips = rentals.groupBy("member_id").agg(
        F.min(F.when(F.col("delivery_date") > today, F.col("delivery_date"))).alias("next_delivery_date"),
        F.max(F.when(F.col("delivery_date") <= today, F.col("delivery_date"))).alias("most_recent_delivery_date"),
        F.max("pick_up_date").alias("_last"))
    owners = ids_of(idmap, STORE, "user_id").join(registry.select("user_id").distinct(), "user_id", "left_semi")
    owners = owners.select("member_id").distinct().withColumn("_registry", F.lit(1))
    status = F.regexp_replace("member_status", "[0-9].", "")
    out = members.filter(F.col("membership_start_dt") <= today).join(trips, "member_id", "left").join(owners, "member_id", "left")
    return out.select(
        "member_id", "email", "next_delivery_date", "most_recent_delivery_date", status.alias("status"), "membership_type",
        F.col("membership_start_dt").alias("membership_start_date"), F.col("membership_end_dt").alias("membership_end_date"),
        F.when(F.ltrim(status) == inactive, F.col("_last")).alias("inactive_date"),
        F.coalesce("_registry", F.lit(0)).alias("registry_user"))


def visit_gaps(rentals: DataFrame) -> DataFrame:
    """Days from the first to the second delivery day per member."""
    days = rentals.filter("member_id is not null and delivery_date is not null").select("member_id", "delivery_date").distinct()
    firsts = days.groupBy("member_id").agg(F.min("delivery_date").alias("_first"))
    second = days.join(firsts, "member_id").filter("delivery_date > _first").groupBy("member_id", "_first").agg(F.min("delivery_date").alias("_second"))
    return second.select("member_id", F.datediff("_second", "_first").alias("days_to_second_order"))


def rental_summary(rentals: DataFrame, flagship: str, as_of: date | str) -> DataFrame:
    """Rentals per member: all, active, monthly value, visits, flagship."""
    today = day(as_of)
    out, back, main = F.col("delivery_date"), F.col("pick_up_date"), F.col("sku") == flagship
    home = (out <= today) & (back.isNull() | (back >= today))
    one = lambda test: F.coalesce(F.max(F.when(test, 1)), F.lit(0))
    return rentals.groupBy("member_id").agg(
        F.count(F.lit(1)).alias("all_time_rented_products"), F.count_if(home).alias("active_products"),
        F.sum(F.when(home, F.col("avg_price")).otherwise(0)).cast(MONEY).alias("current_mrr"),
        F.countDistinct("delivery_date").alias("visit_count"), one(main & home).alias("has_flagship_in_home"),
        one(~main & home).alias("has_other_in_home"),
        F.sum(F.when(main & (out <= today), F.datediff(F.coalesce(back, today), out))).alias("flagship_days"))


def web_summary(web: DataFrame, members: DataFrame, channels: DataFrame, flagship: str, direct_mark: str) -> DataFrame:
    """Web activity per member before the start of the membership.

    channels: channel_source_id, channel_name.
    """
    starts = members.select("member_id", "membership_start_dt")
    ev = web.filter("member_id is not null").join(starts, "member_id")
    prior = F.col("timestamp").cast("timestamp") < F.col("membership_start_dt").cast("timestamp")
    viewed = F.col("src_tbl") == "product_viewed"
    first_page = ev.groupBy("member_id", "session_id").agg(
        first_value(F.when(F.col("src_tbl") == "pages", F.col("url")), "timestamp", "id").alias("_page"),
        F.max(F.when(viewed & (F.col("product_id") == flagship), 1).otherwise(0)).alias("_saw"),
        F.min("session_start_ts").alias("_start"))
    per_session = first_page.groupBy("member_id").agg(
        F.max(F.when(F.col("_page").ilike(direct_mark), 1).otherwise(0)).alias("is_direct_to_flagship"),
        F.min_by("_saw", F.struct("_start", "session_id")).alias("saw_flagship"))
    per_member = ev.groupBy("member_id").agg(
        F.min_by("user_first_session_channel_id", F.struct("timestamp", "id")).alias("channel_source_id"),
        first_value("product_id", "timestamp", "id").alias("first_product_viewed"),
        first_value("url", "timestamp", "id").alias("first_url_viewed"), F.min("timestamp").alias("first_touch_ts"),
        F.countDistinct(F.when(prior, F.col("session_id"))).alias("num_sessions_prior_to_conversion"),
        F.countDistinct(F.when(prior & viewed, F.col("product_id"))).alias("num_unique_products_viewed_prior_to_conversion"))
    out = per_member.join(per_session, "member_id")
    return lookup(out, channels.select("channel_source_id", F.col("channel_name").alias("first_touch_channel")), "channel_source_id")


def member_codes(orders: DataFrame) -> DataFrame:
    """Distinct discount codes of a member, in order, ',' between."""
    codes = orders.filter("member_id is not null").select("member_id", F.explode("discount_codes.code").alias("code"))
    pairs = codes.filter("code is not null").distinct()
    return pairs.groupBy("member_id").agg(F.array_join(F.array_sort(F.collect_list("code")), ",").alias("member_discount_codes"))


def compare_baskets(order_baskets: DataFrame, rental_baskets: DataFrame) -> DataFrame:
    """First and second basket per member, from the side that came first.

    The storefront side counts when its first order is before the first
    delivery.
    """
    fields = ("basket_ct", "basket_dollars", "membership_dollars", "total_discounts", "basket_products", "has_flagship")

    def side(df, at, tag):
        wide = None
        for n, word in ((1, "first"), (2, "second")):
            part = df.filter((F.col("dense_rank") == n) & F.col("member_id").isNotNull()).select(
                "member_id", F.col(at).cast("timestamp").alias(f"{tag}_{word}_ts"),
                *[F.col(c).alias(f"{tag}_{word}_{c}") for c in fields])
            wide = part if wide is None else wide.join(part, "member_id", "left")
        return wide

    both = side(order_baskets, "order_ts", "o").join(side(rental_baskets, "delivery_date", "r"), "member_id", "full_outer")
    never = F.lit("9999-12-31").cast("timestamp")
    store = F.coalesce("o_first_ts", never) < F.coalesce("r_first_ts", never)
    pick = lambda word, c: F.when(store, F.col(f"o_{word}_{c}")).otherwise(F.col(f"r_{word}_{c}"))
    zero = F.lit(0).cast(MONEY)
    cash = lambda word, c: F.coalesce(pick(word, c), zero)
    out = both.select(
        "member_id", F.coalesce(pick("first", "has_flagship") == 1, F.lit(False)).alias("is_flagship_customer"),
        *[x for word, tag in (("first", "initial"), ("second", "second")) for x in (
            pick(word, "basket_ct").alias(f"{tag}_basket_ct"), pick(word, "basket_products").alias(f"{tag}_basket_products"),
            cash(word, "basket_dollars").alias(f"{tag}_basket_product_dollars_gross"),
            cash(word, "membership_dollars").alias(f"{tag}_membership_total"),
            cash(word, "total_discounts").alias(f"{tag}_basket_discounts"))])
    for tag in ("initial", "second"):
        gross = F.col(f"{tag}_basket_product_dollars_gross") + F.col(f"{tag}_membership_total")
        out = out.withColumn(f"{tag}_basket_total_dollars_gross", gross.cast(MONEY)).withColumn(
            f"{tag}_basket_total_dollars_net", (gross - F.col(f"{tag}_basket_discounts")).cast(MONEY))
    alone = (F.col("initial_basket_ct") == 1) & F.col("is_flagship_customer")
    return out.withColumn("first_order_flagship_only", F.when(alone, 1).otherwise(0))


def member_agg(members: DataFrame, web: DataFrame, rentals_by_member: DataFrame, baskets: DataFrame, codes: DataFrame,
               ledger: DataFrame, gaps: DataFrame, as_of: date | str) -> DataFrame:
    """One row per member with a started membership; all inputs by member.

    web: `web_summary`; rentals_by_member: `rental_summary`; baskets:
    `compare_baskets`; codes: `member_codes`; gaps: `visit_gaps`.
    """
    base = members.filter(F.col("membership_start_dt") <= day(as_of)).select(
        "member_id", "membership_start_dt", "membership_end_dt", "membership_type", "number_of_children",
        "youngest_child_dob", "expecting_at_sign_up", "ops_location")
    revenue = ledger.filter("member_id is not null").groupBy("member_id").agg(F.sum("net_sales").cast(MONEY).alias("total_revenue"))
    out = base
    for table in (web, rentals_by_member, baskets, codes, revenue, gaps):
        out = out.join(table, "member_id", "left")
    return out


def churn_listing(contacts: DataFrame, members: DataFrame, attribution: DataFrame, orders: DataFrame,
                  lines: DataFrame, products: DataFrame) -> DataFrame:
    """Members with a monthly end date, what they ordered and how they came."""
    terms = contacts.filter("monthly_membership_end_date is not null").select(
        F.col("id").alias("hubspot_customer_id"), F.col("monthly_membership_end_date").alias("membership_end_dt"))
    goods = products.filter(~like_any("product_name", ("%membership%", "%plan%"))).select("sku", "product_name")
    bought = lines.join(goods, "sku").join(
        orders.filter(F.col("order_type") != RENEWAL).select("order_id", "member_id"), "order_id").filter("member_id is not null")
    per_sku = bought.groupBy("member_id", "sku", "product_name").agg(F.count(F.lit(1)).alias("_n"), F.sum("price").alias("_mrr"))
    stats = per_sku.groupBy("member_id").agg(
        F.sum("_mrr").cast(MONEY).alias("ordered_mrr"), F.count(F.lit(1)).alias("ordered_product_count"),
        name_list("product_name", "_n").alias("products"))
    touch = attribution.filter("first_touch_weighting = 1").select("member_id", F.col("channel_id").alias("first_touch_channel"))
    about = members.select(
        "hubspot_customer_id", "member_id", "first_name", "last_initial", "membership_start_dt", "first_delivery_dt",
        "last_pick_up_dt", "city", "child_1_dob", "child_2_dob", "child_3_dob")
    out = terms.join(about, "hubspot_customer_id").drop("hubspot_customer_id")
    return out.join(touch, "member_id", "left").join(stats, "member_id", "left")
