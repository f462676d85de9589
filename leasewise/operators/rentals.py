"""Rental episodes, items, depreciation, daily revenue and SKU performance."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import day, expand_days, overlap_days, running_total
from ..functions.exprs import (
    MONEY, RATE, before, blank_to_null, first_match, like_any, number_id, parse_date, parse_money,
)
from ..session import cut_step
from ..sources.daytables import DayTable, days_of, overlapping, touched_days
from .identity import CRM, ids_of
from .ordered import first_rows, lookup

# Order-line statuses that are not rentals.
CLOSED = ("Closed-Refunded", "Closed-Non-inventory", "Closed-Duplicate", "Closed-Registry",
          "Closed-Test", "Closed-Trial", "Closed")
NOT_RENTED = ("% plan%", "%membership%")
OPS_REGIONS = {"bay %": "SF", "ny %": "NYC"}
DEPRECIATION_DAYS = 720


def region_of(c: str | Column, regions: Mapping[str, str] = OPS_REGIONS) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return first_match([(c.ilike(p), name) for p, name in regions.items()])


def fact_rental(order_lines: DataFrame, deliveries: DataFrame, picks: DataFrame, pickups: DataFrame,
                customers: DataFrame, idmap: DataFrame, prices: DataFrame, products: DataFrame,
                regions: Mapping[str, str] = OPS_REGIONS) -> DataFrame:
    """One row per rented line (and picked asset): item, member, dates, price.

    The latest delivery and pickup that were not cancelled count, ranked by
    the line they are joined on.  A line without a known product is dropped,
    as its name cannot be told from a plan.
    """
    latest = lambda df, ref: first_rows(df, ref, [F.col("date_modified").desc_nulls_last(), F.col("record_id").desc()])
    out_trip = latest(deliveries.filter("delivery_status <> 'Scheduled Delivery Cancelled'"), "related_order_line_ref").select(
        F.col("related_order_line_ref").alias("id"), "related_order_line", "scheduled_delivery_date")
    ref = "delivery_performance_picking_scheduled_delivery_related_order_line_ref"
    back_trip = latest(pickups.filter("scheduled_pickup_status <> 'Scheduled Pickup Cancelled'"), ref).select(
        F.col(ref).alias("id"), "scheduled_pickup_date")
    assets = picks.select(F.col("asset_tag_association_asset_tag").alias("bin"),
                          F.col("scheduled_delivery_related_order_line").alias("related_order_line"))
    assets = assets.repartition("related_order_line").distinct()  # dealt once, by the key they are joined on
    names = products.filter(~like_any("product_name", NOT_RENTED)).select("sku")

    lines = order_lines.filter(~F.col("qb_ol_status").isin(*CLOSED)).withColumnRenamed("qb_item_sku", "sku")
    # Both by sku first, then both by line; members, the widest value, come last.
    lines = lookup(lines.join(names, "sku", "left_semi"), prices.select("sku", F.col("avg_price").alias("_low")), "sku").select(
        "id", number_id("order_id").alias("order_id"), "sku", F.coalesce(parse_money("price"), "_low").alias("avg_price"),
        number_id("qb_order_related_customer").alias("_customer"),
        region_of("order_id_qb_inventory_location_inventory_location_name", regions).alias("ops_location"))
    lines = cut_step(lookup(lookup(lines, out_trip, "id"), back_trip, "id").select(
        before("id", ".").alias("line_item_id"), "related_order_line", "order_id", "sku", "avg_price", "_customer", "ops_location",
        parse_date("scheduled_delivery_date").alias("delivery_date"), parse_date("scheduled_pickup_date").alias("pick_up_date")))
    lines = lookup(lines, assets, "related_order_line").drop("related_order_line")
    people = customers.select(F.col("id").cast("long").cast("string").alias("_customer"), F.col("hubspot_id").alias("_crm"))
    people = lookup(people, ids_of(idmap, CRM, "_crm"), "_crm").select("_customer", "member_id")
    return lookup(lines, people, "_customer").select(
        "bin", "member_id", "line_item_id", "sku", "order_id", "delivery_date", "pick_up_date", "avg_price", "ops_location")


def fact_rental_sheets(sheets: Mapping[str, DataFrame], idmap: DataFrame, orders: DataFrame, lines: DataFrame,
                       raw_orders: DataFrame, prices: DataFrame) -> DataFrame:
    """Rental episodes kept in one sheet per region.

    Price: the first the member paid for the sku, else the lowest variant.
    """
    rows = None
    for region, df in sheets.items():
        part = df.withColumn("ops_location", F.lit(region))
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.withColumnRenamed("item_id", "sku")
    paid = orders.select("order_id", "member_id", "order_ts").join(lines.select("order_id", "line_item_id", "sku", "price"), "order_id")
    first = first_rows(paid.filter("member_id is not null"), ["member_id", "sku"], ["order_ts", "line_item_id"]).select("member_id", "sku", "price")
    numbers = raw_orders.select(F.col("order_number").cast("string").alias("shopify_order_id"), F.col("id").alias("order_id"))
    out = lookup(rows, ids_of(idmap, CRM, "hubspot_customer_id"), "hubspot_customer_id")
    out = lookup(out.withColumn("shopify_order_id", F.col("shopify_order_id").cast("string")), numbers, "shopify_order_id")
    out = lookup(out, prices.select("sku", F.col("avg_price").alias("_low")), "sku")
    out = lookup(out, first, ["member_id", "sku"])
    return out.select(
        "member_id", "bin", "sku", "order_id", parse_date("delivery_date").alias("delivery_date"),
        parse_date("pick_up_date").alias("pick_up_date"), "restocking_clean_repair_time",
        F.coalesce("price", "_low").alias("avg_price"), "ops_location")


def dim_subscriptions(rentals: DataFrame) -> DataFrame:
    """Each rental as an interval with a price."""
    none = F.lit(None).cast("string")
    return rentals.select(
        "member_id", "sku", none.alias("subscription_id"), F.col("avg_price").alias("gross_price"),
        F.col("avg_price").alias("net_price"), F.lit(1).alias("quantity"),
        F.col("delivery_date").alias("start_dt"), F.col("pick_up_date").alias("end_dt"), none.alias("status"))


def dim_item(inventory: DataFrame, tags: DataFrame, sales: DataFrame, scraps: DataFrame,
             regions: Mapping[str, str] | None = None) -> DataFrame:
    """One row per asset: costs, sold / scrapped flags, region.

    Repeated tags, sales or scraps of an asset count once (the latest record).
    """
    last = lambda df: first_rows(df, "asset_tag", [F.col("record_id").desc()])
    built = last(tags).select("asset_tag", "asset_build_time_actual")
    sold = last(sales.withColumnRenamed("asset_tag_association_asset_tag", "asset_tag")).select(
        "asset_tag", F.col("record_id").alias("_sold"), "asset_sale_date", "sale_amount")
    gone = last(scraps.withColumnRenamed("asset_tag_association_asset_tag", "asset_tag")).select(
        "asset_tag", F.col("record_id").alias("_gone"), "scrap_date")
    out = lookup(lookup(lookup(inventory, built, "asset_tag"), sold, "asset_tag"), gone, "asset_tag")
    place = "inventory_location_inventory_location_name"
    return out.select(
        F.col("asset_tag").alias("bin"), F.col("item_sku").alias("sku"), F.col("item_category").alias("category"),
        F.col("item_name").alias("item_name"), F.col("merchant").alias("store"),
        F.col("payment_method").alias("purchase_method"), parse_date("purchase_date").alias("purchase_date"),
        parse_money("cost_pretax_price").alias("retail_price"), parse_money("cost_pretax_price").alias("actual_purchase_price"),
        parse_money("cost_sales_tax").alias("actual_tax_cost"), parse_money("cost_shipping").alias("actual_shipping_cost"),
        parse_money("cost_total").alias("actual_total_cost"),
        blank_to_null("asset_build_time_actual").try_cast("double").alias("assembly_time"),
        F.col("inventory_status").alias("bin_status"), F.col(place).alias("location"),
        blank_to_null("date_asset_received").isNotNull().alias("received"),
        parse_date("estimated_arrival_date").alias("estimated_actual_arrival"), F.col("receipt_document").alias("tracking_info"),
        F.col("_sold").isNotNull().alias("asset_sold"), parse_date("asset_sale_date").alias("asset_sale_date"),
        parse_money("sale_amount").alias("asset_sale_amount"), F.col("_gone").isNotNull().alias("asset_scrapped"),
        parse_date("scrap_date").alias("scrap_date"),
        region_of(place, regions or {"%bay%": "SF", "NY %": "NY"}).alias("ops_location"))


def depreciation_spans(items: DataFrame, rentals: DataFrame, life_days: int = DEPRECIATION_DAYS) -> DataFrame:
    """One interval per delivered asset: first_delivery_date, _end, purchase_amt and the expense of a day."""
    starts = rentals.groupBy("bin").agg(F.min("delivery_date").alias("first_delivery_date"))
    return (
        items.select("bin", F.col("actual_purchase_price").alias("purchase_amt")).join(starts, "bin")
        .withColumn("depreciation_expense", (F.col("purchase_amt") / life_days).cast(RATE))
        .withColumn("_end", F.date_add("first_delivery_date", life_days)))


def _depreciated(days: DataFrame, first: date | str) -> DataFrame:
    position = F.datediff("date", F.greatest("first_delivery_date", day(first))) + 1
    return days.withColumn("depreciated_amount", (F.col("depreciation_expense") * position).cast(RATE)).select(
        "date", "bin", "purchase_amt", "depreciation_expense", "depreciated_amount",
        (F.col("purchase_amt") - F.col("depreciated_amount")).cast(RATE).alias("remaining_value"))


def daily_depreciation(items: DataFrame, rentals: DataFrame, first: date | str, last: date | str,
                       life_days: int = DEPRECIATION_DAYS) -> DataFrame:
    """Straight line from the first delivery, one row per asset and day.

    Days run from the later of first delivery and `first` to `last`.  The
    accumulated amount counts the listed days, so it is the day's position
    times the daily amount and needs no window.
    """
    base = depreciation_spans(items, rentals, life_days).filter(F.col("first_delivery_date") <= day(last))
    return _depreciated(expand_days(base, "first_delivery_date", "_end", last, first), first)


def refresh_depreciation(table: DayTable, old: DataFrame, new: DataFrame, first: date | str, last: date | str,
                         old_last: date | str | None = None) -> list:
    """Bring a table of `daily_depreciation` from the `old` to the `new` `depreciation_spans`; returns the ranges of days rebuilt.

    Both are keyed by asset; keep the spans of a build for the next one.
    """
    touched = touched_days(old, new, "first_delivery_date", "_end", first, last, ["bin"], old_last)
    return table.refresh(touched, _depreciation_rows(new, first, last))


def _depreciation_rows(spans: DataFrame, first: date | str, last: date | str) -> Callable[[list], DataFrame]:
    def rows(ranges: list) -> DataFrame:
        near = overlapping(spans, "first_delivery_date", "_end", ranges)
        return _depreciated(near.withColumn("date", F.explode(days_of("first_delivery_date", "_end", ranges, last, first))), first)

    return rows


def build_depreciation(table: DayTable, spans: DataFrame, first: date | str, last: date | str) -> DataFrame:
    """The table of `daily_depreciation` from `depreciation_spans`, which are read once per period: write them first."""
    return table.build(spans.sparkSession, first, last, _depreciation_rows(spans, first, last))


def daily_rate(price: str | Column, plan: str | Column | None = None) -> Column:
    """Revenue of one day: monthly price x 12 / 365, annual price / 365."""
    price = F.col(price) if isinstance(price, str) else price
    monthly = (price.cast(MONEY) * 12 / 365).cast(RATE)
    if plan is None:
        return monthly
    plan = F.col(plan) if isinstance(plan, str) else plan
    return F.when(plan == "annual", (price.cast(MONEY) / 365).cast(RATE)).otherwise(monthly)


def revenue_intervals(subs: DataFrame, memberships: DataFrame) -> DataFrame:
    """Rental and membership intervals with their daily rate."""
    none = F.lit(None).cast("string")
    rental = subs.select("member_id", "sku", none.alias("membership_type"), "start_dt", "end_dt", daily_rate("net_price").alias("revenue"))
    plan = memberships.filter("membership_type <> 'per-item'").select(
        "member_id", none.alias("sku"), "membership_type", "start_dt", "end_dt", daily_rate("price", "membership_type").alias("revenue"))
    return rental.unionByName(plan)


def daily_revenue(subs: DataFrame, memberships: DataFrame, as_of: date | str, first: date | str) -> DataFrame:
    """One row per member, day and interval from `first` to `as_of`."""
    days = expand_days(revenue_intervals(subs, memberships), "start_dt", "end_dt", as_of, first)
    return days.select("member_id", "date", "sku", "membership_type", "revenue")


def refresh_revenue(table: DayTable, old: DataFrame, new: DataFrame, first: date | str, as_of: date | str,
                    old_as_of: date | str | None = None) -> list:
    """Bring a table of `daily_revenue` from the `old` to the `new` `revenue_intervals`; returns the ranges of days rebuilt."""
    touched = touched_days(old, new, "start_dt", "end_dt", first, as_of, (), old_as_of)

    def rows(ranges: list) -> DataFrame:
        near = overlapping(new, "start_dt", "end_dt", ranges)
        return near.withColumn("date", F.explode(days_of("start_dt", "end_dt", ranges, as_of, first))).select(
            "member_id", "date", "sku", "membership_type", "revenue")

    return table.refresh(touched, rows)


def daily_revenue_totals(subs: DataFrame, memberships: DataFrame, as_of: date | str, first: date | str,
                         by: tuple[str, ...] = ()) -> DataFrame:
    """Total revenue per day without expanding the intervals."""
    rows = revenue_intervals(subs, memberships)
    return running_total(rows, "start_dt", "end_dt", "revenue", first, as_of, by, "revenue")


def sku_agg(products: DataFrame, items: DataFrame, rentals: DataFrame, as_of: date | str,
            first: date | str, bought_after: date | str = "2019-01-01") -> DataFrame:
    """Inventory, dwell time, rentals, members, MRR and revenue per SKU.

    Revenue is rate x days between `first` and the day before `as_of`, which
    equals the sum of the daily rows.
    """
    today = day(as_of)
    began = rentals.groupBy("bin").agg(F.min("delivery_date").alias("_began"))
    dated = F.col("purchase_date") > day(bought_after)
    dwell, held = F.when(dated, F.datediff("_began", "purchase_date")), F.when(dated, F.datediff(today, "purchase_date"))
    stock = lookup(items.select("bin", "sku", "purchase_date"), began, "bin").groupBy("sku").agg(
        F.count("bin").alias("inventory_count"), F.avg(dwell).alias("dwell_time"),
        F.sum(held).alias("total_inventory_days"), (F.sum(held) - F.sum(dwell)).alias("non_dwell_inventory_days"))
    start, end = F.col("delivery_date"), F.col("pick_up_date")
    active = (start <= today) & (end.isNull() | (end >= today))
    yesterday = date.fromisoformat(str(as_of)) - timedelta(days=1)
    days = overlap_days(start, end, first, yesterday)
    use = rentals.groupBy("sku").agg(
        F.countDistinct(F.when(active & (F.col("bin") != ""), F.col("bin"))).alias("active_count"),
        F.count(F.lit(1)).alias("rental_count"),
        F.avg(F.when(end.isNotNull(), F.datediff(end, start))).alias("avg_completed_duration"),
        F.avg(F.when(end.isNull(), F.datediff(today, start))).alias("avg_active_duration"),
        F.countDistinct("member_id").alias("total_members"),
        F.sum(F.when(active, F.col("avg_price")).otherwise(0)).cast(MONEY).alias("current_mrr"),
        F.sum(F.when(start < today, F.datediff(F.coalesce(end, today), start))).alias("total_rental_days"),
        F.sum(daily_rate("avg_price") * days).cast(RATE).alias("total_revenue"))
    named = products.select("sku", "product_name").distinct()
    return named.join(stock, "sku", "left").join(use, "sku", "left").select(
        "sku", "product_name", "inventory_count", "active_count", "rental_count", "avg_completed_duration",
        "avg_active_duration", "dwell_time", "total_revenue", "total_members", "current_mrr",
        "total_inventory_days", "total_rental_days", "non_dwell_inventory_days")


def duration_stats(rentals: DataFrame, skus: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Min, max, mean and median days of completed rentals."""
    done = rentals.filter("pick_up_date is not null and delivery_date is not null")
    if skus is not None:
        done = done.filter(F.col("sku").isin(*skus))
    days = done.withColumn("_days", F.datediff("pick_up_date", "delivery_date"))
    # The state of a median is a count per distinct length, so it stays small.
    return days.groupBy(*by).agg(
        F.min("_days").alias("min_duration"), F.max("_days").alias("max_duration"), F.avg("_days").alias("avg_duration"),
        F.median("_days").alias("median_duration"), F.count(F.lit(1)).alias("observations"))


def open_rentals(rentals: DataFrame, as_of: date | str, skus: Sequence[str] | None = None) -> DataFrame:
    """Rentals without a pickup by delivery day, with their age in days."""
    live = rentals.filter("pick_up_date is null")
    if skus is not None:
        live = live.filter(F.col("sku").isin(*skus))
    return live.groupBy("delivery_date").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "days_open", F.datediff(day(as_of), F.col("delivery_date")))


def scheduled_items(rentals: DataFrame, prices: DataFrame, as_of: date | str, customer: str = "member_id") -> DataFrame:
    """Future deliveries: items, customers and monthly revenue, in one row."""
    ahead = rentals.filter(F.col("delivery_date") > day(as_of)).select(customer, "sku")
    return lookup(ahead, prices.select("sku", F.col("avg_price").alias("_price")), "sku").agg(
        F.count(F.lit(1)).alias("scheduled_items"), F.countDistinct(customer).alias("customers_with_scheduled_items"),
        F.sum("_price").cast(MONEY).alias("scheduled_mrr"))
