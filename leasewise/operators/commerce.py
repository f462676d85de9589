"""Store orders, lines, refunds, the transaction ledger and baskets.

Raw tables keep JSON as text: orders.customer, discount_codes, refunds and
shipping_address, line_items.discount_allocations.
Money is decimal(18,2) from the first parse on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import expand_units
from ..functions.exprs import (
    MONEY, binned, blank_to_null, iso_utc, json_first, json_rows, json_text,
    letters_digits, like_any, mapped, money, month_of, parse_money,
    parse_timestamp,
)
from ..session import cut_step
from .identity import STORE, ids_of
from .ordered import first_rows, flag_first, lookup, numbered

# Labels of the order source names.
SALES_CHANNELS = {
    "shopify_draft_order": "Draft Orders",
    "subscription_contract": "Bold Subscriptions",
    "web": "Online Store",
    "3890849": "Shop",
    "580111": "Registry Storefront",
}
MEMBERSHIP_NAMES = ("%membership%", "%plan")
BASKET_BOUNDS = (50, 100, 150, 200)
RENEWAL = "subscription_contract"


def is_membership_name(c: str | Column) -> Column:
    return like_any(c, MEMBERSHIP_NAMES)


# --- products and prices ---------------------------------------------------

def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        F.col("id").alias("sku"), F.col("title").alias("product_name"),
        F.col("created_at").alias("product_created_ts"), F.col("updated_at").alias("product_updated_ts"),
        F.col("published_at").alias("product_published_ts"), F.col("handle").alias("product_page_handle"),
        F.col("status").alias("product_status"), F.col("tags").alias("product_tags"))


def sku_price(products: DataFrame, variants: DataFrame) -> DataFrame:
    """Lowest variant price per product; null when it has no variant."""
    low = variants.groupBy("product_id").agg(F.min(money("price")).alias("avg_price"))
    return products.select(F.col("id").alias("sku")).join(
        low.withColumnRenamed("product_id", "sku"), "sku", "left")


# --- lines and orders ------------------------------------------------------

def fact_line_item(line_items: DataFrame) -> DataFrame:
    """Order lines; the discount is the first allocation, else 0."""
    discount = json_first("discount_allocations", "amount string")["amount"].try_cast(MONEY)
    return line_items.select(
        F.col("id").alias("line_item_id"), "order_id", F.col("gift_card").alias("is_gift_card"),
        money("price").alias("price"), F.col("quantity").cast("int").alias("quantity"), "vendor",
        F.col("product_id").alias("sku"), "variant_id",
        F.coalesce(discount, F.lit(0).cast(MONEY)).alias("total_discount"))


CODE_FIELDS = "code string, amount string, type string"


def order_codes(orders: DataFrame) -> DataFrame:
    """One row per discount code of an order."""
    codes = orders.select(F.col("id").alias("order_id"), F.posexplode(json_rows("discount_codes", CODE_FIELDS)))
    return codes.select(
        "order_id", F.col("pos").alias("ordinal"), blank_to_null("col.code").alias("discount_code"),
        F.col("col.amount").try_cast(MONEY).alias("discount_amount"),
        blank_to_null("col.type").alias("discount_type"))


def gift_card_orders(line_items: DataFrame, products: DataFrame) -> DataFrame:
    """Orders in which every line is a gift card."""
    titles = products.select(F.col("id").alias("product_id"), "title")
    gift = F.coalesce(F.col("title").ilike("%gift card%"), F.lit(False)) | \
        F.coalesce(F.col("name").ilike("%gift card%"), F.lit(False))
    per_order = lookup(line_items.select("order_id", "product_id", "name"), titles, "product_id").groupBy("order_id").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(gift).alias("gifts"))
    return per_order.filter("gifts > 0 and lines = gifts").select("order_id")


def membership_orders(line_items: DataFrame, orders: DataFrame, products: DataFrame,
                      customers: DataFrame, idmap: DataFrame, prices: DataFrame) -> DataFrame:
    """Earliest order per member with a membership or plan product."""
    plans = products.filter(like_any("title", ("%member%", "%plan"))).select(
        F.col("id").alias("product_id"), F.col("title").alias("membership_product_name"))
    lines = line_items.select("order_id", "product_id").join(plans, "product_id")
    heads = orders.select(F.col("id").alias("order_id"), "created_at", json_text("customer", "id").alias("customer_id"))
    out = lines.join(heads, "order_id")
    out = lookup(out, ids_of(idmap, STORE, "customer_id"), "customer_id")
    out = lookup(out, customers.select(F.col("id").alias("customer_id"), "email"), "customer_id")
    out = lookup(out, prices.select(F.col("sku").alias("product_id"), F.col("avg_price").alias("membership_price")), "product_id")
    return first_rows(out, "member_id", [F.col("created_at").asc_nulls_last(), "order_id", "product_id"]).select(
        "email", "member_id", "created_at", "membership_product_name", "order_id", "product_id", "membership_price")


def fact_order(orders: DataFrame, idmap: DataFrame, membership: DataFrame, gifts: DataFrame) -> DataFrame:
    """One row per order, its discount codes in an array.

    membership, gifts: tables with an order_id column (`membership_orders`,
    `gift_card_orders`).  `order_codes` has one row per code.
    """
    codes = F.transform(json_rows("discount_codes", CODE_FIELDS), lambda c: F.struct(
        c["code"].alias("code"), c["amount"].try_cast(MONEY).alias("amount"), c["type"].alias("type")))
    base = orders.select(
        F.col("id").alias("order_id"), json_text("customer", "id").alias("_customer"), "order_number",
        F.col("source_name").alias("order_type"), F.col("created_at").alias("order_ts"),
        F.col("processed_at").alias("processed_ts"), parse_money("total_discounts").alias("order_discounts"),
        parse_money("total_line_items_price").alias("order_gross"), parse_money("total_tax").alias("order_tax"),
        parse_money("total_price_usd").alias("order_total"), "financial_status",
        F.col("updated_at").alias("updated_ts"), codes.alias("discount_codes"))
    ids = ids_of(idmap, STORE, "_customer")
    out = lookup(base, ids, "_customer").drop("_customer")
    for name, table in (("is_membership_order", membership), ("is_gift_card_order", gifts)):
        marked = table.select("order_id").distinct().withColumn(f"_{name}", F.lit(True))
        out = out.join(marked, "order_id", "left").withColumn(name, F.coalesce(f"_{name}", F.lit(False))).drop(f"_{name}")
    return out


def discount_codes(fact_orders: DataFrame) -> DataFrame:
    """Orders with a code, one row per code."""
    return fact_orders.select("order_id", "member_id", "order_ts", F.explode("discount_codes").alias("c")).select(
        "order_id", "member_id", "order_ts", F.col("c.code").alias("discount_code"),
        F.col("c.amount").alias("discount_amount"), F.col("c.type").alias("discount_type")
    ).filter("discount_code is not null")


# --- refunds ---------------------------------------------------------------

REFUND_LINE = ("id string, line_item_id string, quantity string, restock_type string, subtotal string, "
               "total_tax string, total_discount string, requires_shipping string, price string")
REFUND = ("id string, order_id string, created_at string, processed_at string, restock string, "
          "order_adjustments array<struct<amount string>>, transactions string, "
          f"refund_line_items array<struct<{REFUND_LINE}>>")


def fact_refund(orders: DataFrame, idmap: DataFrame) -> DataFrame:
    """One row per refund of an order; refunded lines stay nested."""
    refunds = orders.select(json_text("customer", "id").alias("_customer"), F.explode(json_rows("refunds", REFUND)).alias("r"))
    ids = ids_of(idmap, STORE, "_customer")
    return lookup(refunds, ids, "_customer").select(
        F.col("r.id").alias("refund_id"), "member_id", blank_to_null("r.order_id").alias("order_id"),
        parse_timestamp("r.created_at").alias("created_ts"), parse_timestamp("r.processed_at").alias("processed_ts"),
        F.coalesce(F.col("r.restock") == "true", F.lit(False)).alias("restock"),
        F.try_element_at("r.order_adjustments", F.lit(1))["amount"].try_cast(MONEY).alias("order_adjustments"),
        F.col("r.transactions").alias("transactions"), F.col("r.refund_line_items").alias("refund_line_items"))


def fact_refund_line_item(refunds: DataFrame) -> DataFrame:
    """One row per refunded line."""
    rows = refunds.select("refund_id", "order_id", F.explode("refund_line_items").alias("l"))
    return rows.select(
        blank_to_null("l.id").alias("refund_line_item_id"), "refund_id", "order_id",
        blank_to_null("l.line_item_id").alias("line_item_id"), F.col("l.quantity").try_cast("int").alias("quantity"),
        F.col("l.restock_type").alias("restock_type"),
        *[F.col(f"l.{c}").try_cast(MONEY).alias(c) for c in ("subtotal", "total_tax", "total_discount")],
        F.col("l.requires_shipping").alias("requires_shipping"), F.col("l.price").try_cast(MONEY).alias("price"))


# --- ledger ----------------------------------------------------------------

LEDGER_MONEY = ("gross_sales", "discounts", "returns", "net_sales", "taxes", "total_sales")


def fact_transaction(orders: DataFrame, lines: DataFrame, refunds: DataFrame, refund_lines: DataFrame,
                     products: DataFrame, channels: Mapping[str, str] = SALES_CHANNELS) -> DataFrame:
    """Ledger: order lines, refunded lines (negated), positive adjustments.

    All inputs are the facts of this module; orders has one row per order.
    """
    names = products.select("sku", "product_name")
    heads = orders.select("order_id", "order_number", "order_type")
    zero = F.lit(0).cast(MONEY)

    def entry(df, kind, line, member, ts, name, sku, quantity, **amounts):
        return df.select(
            "order_id", member, line.alias("line_item_id"), ts.alias("transaction_ts"), "order_number", "order_type",
            F.lit(kind).alias("sales_type"), mapped("order_type", channels).alias("sales_channel"),
            name.alias("product_name"), sku.alias("sku"), quantity.cast("int").alias("quantity"),
            *[amounts[m].cast(MONEY).alias(m) for m in LEDGER_MONEY])

    # Products meet the lines while these are short, orders come last.
    # A line without a known product keeps no sku, as its product row is missing.
    sold = lookup(lines.select("line_item_id", "order_id", F.col("sku").alias("_sku"), "price", "quantity", "total_discount"),
                  names.withColumn("_sku", F.col("sku")), "_sku").drop("_sku")
    sold = sold.join(orders.select("order_id", "member_id", "order_ts", "order_number", "order_type", "order_tax"), "order_id")
    gross = F.col("price") * F.col("quantity")
    made = entry(
        sold, "order", F.col("line_item_id"), "member_id", F.col("order_ts"), F.col("product_name"), F.col("sku"),
        F.col("quantity"), gross_sales=gross, discounts=F.coalesce("total_discount", zero), returns=zero,
        net_sales=F.col("price") * F.coalesce("quantity", F.lit(1)) - F.col("total_discount"),
        taxes=F.col("order_tax"), total_sales=gross - F.col("total_discount"))

    items = refund_lines.select("order_id", "refund_id", "line_item_id", "quantity", "subtotal", "total_tax", "total_discount")
    items = lookup(items, lines.select("line_item_id", F.col("sku").alias("_sku")), "line_item_id")
    items = lookup(items, names.withColumn("_sku", F.col("sku")), "_sku").drop("_sku")
    back = lookup(refunds.select("order_id", "refund_id", "member_id", "created_ts", "order_adjustments"), heads, "order_id")
    back = back.join(items, ["order_id", "refund_id"], "left")
    returned = F.coalesce(-F.col("subtotal"), F.col("order_adjustments"))
    undone = cut_step(entry(
        back, "return", F.col("line_item_id"), "member_id", F.col("created_ts"), F.col("product_name"), F.col("sku"),
        -F.col("quantity"), gross_sales=zero, discounts=F.coalesce("total_discount", zero), returns=returned,
        net_sales=returned, taxes=F.col("total_tax"), total_sales=returned))

    extra = lookup(refunds.filter("order_adjustments > 0"), heads, "order_id")
    none, adjusted = F.lit(None).cast("string"), F.col("order_adjustments")
    added = entry(
        extra, "return", none, "member_id", F.col("created_ts"), none, none, F.lit(0), gross_sales=adjusted,
        discounts=zero, returns=zero, net_sales=adjusted, taxes=zero, total_sales=adjusted)
    return made.unionByName(undone).unionByName(added)


def special_members(ledger: DataFrame, least: int = 80) -> DataFrame:
    """Members whose refunded membership was replaced by a positive adjustment."""
    refunded = ledger.filter((F.col("quantity") < 0) & is_membership_name("product_name")).select("member_id").distinct()
    paid = ledger.filter(
        (F.col("sales_type") == "return") & (F.col("quantity") == 0) & F.col("product_name").isNull()
        & (F.col("gross_sales") >= least)).select("member_id").distinct()
    return paid.join(refunded, "member_id", "left_semi")


def discount_offsets(orders: DataFrame, days: int = 90) -> DataFrame:
    """Per member and order day: minus the discounts of web orders, for `days` days."""
    used = orders.filter((F.col("order_type") == "web") & (F.col("order_discounts") > 0) & ~F.col("is_membership_order"))
    return used.groupBy("member_id", F.col("order_ts").cast("date").alias("start_date")).agg(
        F.sum(-F.col("order_discounts")).alias("discount_mrr_offset")
    ).withColumn("end_date", F.date_add("start_date", days))


# --- baskets ---------------------------------------------------------------

def baskets_orders(orders: DataFrame, lines: DataFrame, products: DataFrame, flagship: str,
                   skip: Sequence[str] = (RENEWAL,), bounds: Sequence[int] = BASKET_BOUNDS) -> DataFrame:
    """One row per member and order time: what was bought on the nth visit."""
    heads = orders.filter(~F.col("order_type").isin(*skip)).select("order_id", "member_id", "order_ts")
    bought = heads.join(lines.select("order_id", "sku", "price", "quantity", "total_discount"), "order_id", "left")
    # The product name is the reference's `dim_product` title; unknown skus keep null.
    bought = lookup(bought, products.select("sku", "product_name"), "sku").withColumn("amount", F.col("price") * F.col("quantity"))
    plan = like_any("product_name", ("%plan", "%membership"))
    # Per product first, so that the list is built from short rows.
    per_name = bought.groupBy("member_id", "order_ts", "product_name").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_amount"), F.sum("total_discount").alias("_discount"),
        F.max((F.col("sku") == flagship).cast("int")).alias("_flag"))
    per_visit = per_name.groupBy("member_id", "order_ts").agg(
        F.sum("_n").alias("basket_ct"),
        F.sum(F.when(~plan, F.col("_amount"))).cast(MONEY).alias("basket_dollars"),
        F.sum(F.when(plan, F.col("_amount"))).cast(MONEY).alias("membership_dollars"),
        F.max("_flag").alias("has_flagship"), name_list("product_name", "_n").alias("basket_products"),
        F.coalesce(F.sum("_discount"), F.lit(0)).cast(MONEY).alias("total_discounts"),
        (F.sum("_amount") - F.sum("_discount")).cast(MONEY).alias("net_basket_size"))
    return _ranked(per_visit, "order_ts").withColumn("basket_bin", binned("basket_dollars", bounds))


def _ranked(per_visit: DataFrame, ts: str) -> DataFrame:
    # One row per (member, time) already, so numbering it is the dense rank.
    return numbered(per_visit, "member_id", ts, [], "dense_rank")


def name_list(name: str, n: str) -> Column:
    """Aggregate: names in order, each repeated `n` times, ', ' between."""
    pairs = F.collect_list(F.when(F.col(name).isNotNull(), F.struct(F.col(name).alias("name"), F.col(n).alias("n"))))
    repeated = F.flatten(F.transform(F.array_sort(pairs), lambda p: F.array_repeat(p["name"], p["n"].cast("int"))))
    return F.when(F.size(pairs) > 0, F.array_join(repeated, ", "))


def first_dues(lines: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Membership dues and the first dues date per member."""
    plans = products.filter(like_any("product_name", ("%annual%", "%monthly%"))).select("sku")
    paid = lines.join(plans, "sku", "left_semi").join(orders.select("order_id", "member_id", "order_ts"), "order_id", "left")
    return paid.groupBy("member_id").agg(F.min("order_ts").alias("first_order_ts"), F.sum("price").cast(MONEY).alias("member_dues"))


def baskets_rentals(rentals: DataFrame, lines: DataFrame, orders: DataFrame, products: DataFrame,
                    flagship: str, bounds: Sequence[int] = BASKET_BOUNDS) -> DataFrame:
    """One row per member and delivery day: what was delivered on the nth visit.

    Line discounts are summed per (order, sku) before the join, so repeated
    lines do not multiply a rental; the first dues count once per rental.
    """
    off = lines.groupBy("order_id", "sku").agg(F.sum("total_discount").alias("_discount"))
    items = rentals.select("member_id", "delivery_date", "order_id", "sku", "avg_price")
    items = lookup(items, products.select("sku", "product_name"), "sku")
    items = lookup(items, off, ["order_id", "sku"])
    per_name = items.groupBy("member_id", "delivery_date", "product_name").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("avg_price").alias("_amount"), F.sum("_discount").alias("_discount"),
        F.max((F.col("sku") == flagship).cast("int")).alias("_flag"))
    per_visit = per_name.groupBy("member_id", "delivery_date").agg(
        F.sum("_n").alias("basket_ct"), F.sum("_amount").cast(MONEY).alias("basket_dollars"),
        F.max("_flag").alias("has_flagship"), name_list("product_name", "_n").alias("basket_products"),
        F.sum("_discount").cast(MONEY).alias("total_discounts"),
        (F.sum("_amount") - F.sum("_discount")).cast(MONEY).alias("net_basket_size"))
    dues = first_dues(lines, orders, products).select("member_id", "member_dues")
    out = lookup(_ranked(per_visit, "delivery_date"), dues, "member_id")
    return out.withColumn("membership_dollars", (F.col("member_dues") * F.col("basket_ct")).cast(MONEY)).drop(
        "member_dues").withColumn("basket_bin", binned("basket_dollars", bounds))


def nth_basket(baskets: DataFrame, n: int) -> DataFrame:
    return baskets.filter(F.col("dense_rank") == n)


# --- marts on the ledger ---------------------------------------------------

def member_sales(ledger: DataFrame, members: DataFrame) -> DataFrame:
    """Net sales per member and month, with the member's attributes."""
    sums = ledger.groupBy("member_id", month_of("transaction_ts").alias("month")).agg(F.sum("net_sales").cast(MONEY).alias("net_sales"))
    about = members.select(
        "member_id", F.concat("first_name", F.lit(" "), "last_initial").alias("short_name"), "ops_location",
        "membership_type", "member_status", "membership_start_dt", "membership_end_dt")
    return lookup(sums, about, "member_id")


# --- fulfilment views ------------------------------------------------------

def _repeats(line_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with their order's customer, source and whether it is the first
    of that product for the customer."""
    heads = orders.select(
        F.col("id").alias("order_id"), json_text("customer", "id").alias("customer_id"), "source_name",
        F.col("created_at").alias("_ordered"))
    lines = line_items.join(heads, "order_id")
    return flag_first(lines, ["customer_id", "product_id"], ["_ordered", "order_id", "id"], "is_first")


LINE_COLUMNS = ("id", "price", "quantity", "title", "total_discount", "variant_id", "name", "product_id", "order_id")


def renewal_lines(line_items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines that repeat a customer's product and come from renewals."""
    return _repeats(line_items, orders).filter(
        ~F.col("is_first") & (F.col("source_name") == RENEWAL)).select(*LINE_COLUMNS)


def fulfilment_lines(line_items: DataFrame, orders: DataFrame, bundles: DataFrame) -> DataFrame:
    """Lines to fulfil: no renewals, one row per unit, bundles split in two.

    bundles: product_id, extra_name, extra_product_id.  Unit n > 1 has `n-`
    before the id; the second part of a bundle has `9.` before its unit's id,
    and price 0.  All units are listed.
    """
    wanted = F.coalesce("quantity", F.lit(1)).cast("int")
    lines = _repeats(line_items, orders).filter(F.col("is_first") | (F.col("source_name") != RENEWAL)).select(*LINE_COLUMNS)
    counted = lines.withColumn("_units", F.greatest(F.lit(1), wanted))
    n, plain = F.col("unit").cast("string"), F.col("id")
    named = lambda mark: F.concat(F.lit(mark), F.when(F.col("unit") > 1, F.concat(n, F.lit("-"), plain)).otherwise(plain))
    units = expand_units(counted, "_units").select(
        named("").alias("id"), named("9.").alias("_second_id"), "price", F.lit(1).alias("quantity"), "title", "total_discount", "variant_id", "name", "product_id", "order_id",
        F.col("id").alias("raw_order_line_id"), F.coalesce(F.col("quantity") > 1, F.lit(False)).alias("multiple_qty_flag"))
    paired = lookup(units, bundles, "product_id").withColumn("unbundled_flag", F.col("extra_product_id").isNotNull())
    parts = F.when(F.col("unbundled_flag"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = paired.withColumn("_part", F.explode(parts))
    second = F.col("_part") == 1
    pick = lambda a, b: F.when(second, a).otherwise(b)
    return rows.select(
        pick(F.col("_second_id"), F.col("id")).alias("id"),
        pick(F.lit(0), F.col("price")).cast(MONEY).alias("price"), "quantity", "title", "total_discount", "variant_id",
        pick(F.col("extra_name"), F.col("name")).alias("name"),
        pick(F.col("extra_product_id"), F.col("product_id")).alias("product_id"),
        "order_id", "raw_order_line_id", "multiple_qty_flag", "unbundled_flag")


def fulfilment_orders(line_items: DataFrame, orders: DataFrame, addresses: DataFrame,
                      regions: Mapping[str, int]) -> DataFrame:
    """Orders with a first-time line or not from a renewal.

    regions maps a province to its inventory location.
    """
    lines = _repeats(line_items.select("id", "order_id", "product_id"), orders)
    kept = lines.filter(F.col("is_first") | (F.col("source_name") != RENEWAL)).select(F.col("order_id").alias("id")).distinct()
    out = orders.join(kept, "id", "left_semi")
    where = addresses.select(F.col("order_id").alias("id"), "address_id", "province")
    return lookup(out, where, "id").select(
        "id", "order_number", F.col("created_at").cast("date").alias("order_date"),
        json_text("customer", "id").alias("customer_id"), iso_utc("created_at").alias("created_at"),
        iso_utc("updated_at").alias("updated_at"), "subtotal_price", "total_discounts", "financial_status",
        "source_name", F.col("address_id").alias("raw_address_id"),
        mapped("province", dict(regions)).cast("int").alias("raw_inventory_location"))


# Fields of a shipping address.
ADDRESS_FIELDS = (
    "name", "first_name", "last_name", "phone", "address1", "address2", "city", "province",
    "province_code", "zip", "country", "country_code", "latitude", "longitude", "company",
)


def address_key(lat: str, long: str, street: str, extra: str) -> Column:
    """Hash of place and street; null without a street, blanks for the rest."""
    part = lambda c: F.coalesce(F.lower(F.trim(c)), F.lit(""))
    return F.when(blank_to_null(street).isNotNull(), F.md5(F.concat(
        part(F.col(lat)), part(F.col(long)), part(letters_digits(street)), part(letters_digits(extra)))))


def order_addresses(orders: DataFrame) -> DataFrame:
    fields = ", ".join(f"{f} string" for f in ADDRESS_FIELDS)
    parsed = orders.select(F.col("id").alias("order_id"), F.from_json("shipping_address", f"struct<{fields}>").alias("a"))
    flat = parsed.select("order_id", *[F.col(f"a.{f}").alias(f) for f in ADDRESS_FIELDS])
    return flat.withColumn("address_id", address_key("latitude", "longitude", "address1", "address2"))


def shipping_addresses(addresses: DataFrame) -> DataFrame:
    """Latest address (highest order id) per address key."""
    names = {"address1": "address_line_1", "address2": "address_line_2", "province": "state", "latitude": "lat", "longitude": "long"}
    known = addresses.filter("address_id is not null")
    return first_rows(known, "address_id", [F.col("order_id").desc()]).select(
        F.col("address_id").alias("id"), *[F.col(f).alias(names.get(f, f)) for f in ADDRESS_FIELDS])
