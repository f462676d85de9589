"""Cohorts, daily KPIs, targets, waterfall and monthly recurring revenue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions.calendar import day, day_spine, expand_months, expand_units
from ..functions.exprs import MONEY, RATE, first_match, growth, month_of, parse_date, parse_number
from .lifecycle import ANNUAL, MONTHLY, PER_ITEM, PLAN_PRICES
from .ordered import lookup, numbered_all

STATUSES = ("new", "scheduled", "active", "inactive", "lapsed")
TYPES = {"": (ANNUAL, MONTHLY), "_annual": (ANNUAL,), "_monthly": (MONTHLY,), "_per_item": (PER_ITEM,)}
# Status labels that take a lapsed member out of a running count; `dim_members` gives these.
LAPSED_LABELS = {"new": "Pre Active", "scheduled": "Scheduled", "active": "Active", "inactive": "Churned"}
# Names of the statuses in the long form.
LONG_NAMES = {"new": "1. new", "scheduled": "2. scheduled", "active": "3. active", "inactive": "4. inactive"}


def plan_mrr(kind: str | Column = "membership_type") -> Column:
    """Monthly value of a plan: a twelfth of the annual price, or the monthly."""
    kind = F.col(kind) if isinstance(kind, str) else kind
    return first_match([(kind == ANNUAL, F.lit(PLAN_PRICES[ANNUAL] / 12)), (kind == MONTHLY, F.lit(float(PLAN_PRICES[MONTHLY])))], 0.0)


# --- cohorts ---------------------------------------------------------------

def cohort_base(rentals: DataFrame, members: DataFrame, offsets: DataFrame, baskets: DataFrame,
                first: date | str, as_of: date | str) -> DataFrame:
    """One row per rental and month it is active in.

    Membership MRR and the discount offset count on one row per member and
    month.  rentals need a unique line_item_id per row; offsets:
    `discount_offsets`, summed over those valid in the month; baskets: first
    rental baskets, one row per member.

    Months are only made where nothing is shuffled after: the first rental of a
    member and month is found by a minimum that each task takes on its own, and
    a rental is told the months it leads before it is repeated for all of them.
    """
    items = rentals.filter("member_id is not null").select("member_id", "line_item_id", "sku", "delivery_date", "pick_up_date", F.col("avg_price").alias("item_mrr"))
    firsts = items.groupBy("member_id").agg(F.min("delivery_date").alias("first_delivery_date"))
    about = members.select(
        "member_id", "membership_type", "membership_start_dt", "youngest_child_dob", "number_of_children",
        "expecting_at_sign_up", "is_shared_offer").join(firsts, "member_id")
    # Equal rows are one span with a count; the first of its rows leads.
    span = ["sku", "line_item_id", "delivery_date", "pick_up_date", "item_mrr"]
    spans = items.groupBy("member_id", *span).agg(F.count(F.lit(1)).alias("_rows"))
    leads = expand_months(items, "delivery_date", "pick_up_date", first, as_of).groupBy("member_id", "month").agg(F.min(F.struct(*span)).alias("_lead"))
    # Offsets valid at the start of a month: start < month <= end.
    valid = expand_months(
        offsets.withColumn("_from", F.add_months(F.trunc("start_date", "month"), 1)), "_from", "end_date", first, as_of)
    valid = valid.filter("start_date < month and end_date >= month").groupBy("member_id", "month").agg(F.sum("discount_mrr_offset").alias("_offset"))
    led = leads.join(valid, ["member_id", "month"], "left").groupBy(F.col("member_id").alias("_who"), "_lead").agg(
        F.map_from_entries(F.collect_list(F.struct("month", "_offset"))).alias("_led"))
    rows = spans.join(led, F.col("member_id").eqNullSafe(F.col("_who")) & F.struct(*span).eqNullSafe(F.col("_lead")), "left").drop("_who", "_lead")
    rows = rows.join(about, "member_id").join(
        baskets.filter("member_id is not null").select("member_id", "basket_bin", "basket_ct", "basket_dollars", "has_flagship"), "member_id", "left")
    rows = expand_units(expand_months(rows, "delivery_date", "pick_up_date", first, as_of), "_rows", "_row")
    once = F.coalesce(F.map_contains_key("_led", F.col("month")), F.lit(False)) & (F.col("_row") == 1)
    rows = rows.withColumn("_once", once).withColumn("_offset", F.try_element_at("_led", F.col("month")))
    plan = F.when(F.col("_once"), plan_mrr()).otherwise(0.0).cast(RATE)
    off = F.when(F.col("_once"), F.coalesce("_offset", F.lit(0))).otherwise(0).cast(RATE)
    gross = (F.col("item_mrr") + F.col("membership_mrr")).cast(RATE)
    return (
        rows.withColumns({"membership_mrr": plan, "discount_offset": off}).withColumn("gross_mrr", gross)
        .withColumn("net_mrr", (F.col("gross_mrr") + F.col("discount_offset")).cast(RATE))
        .select(
            "month", "member_id", "line_item_id", "sku", month_of("membership_start_dt").alias("member_start_month"),
            month_of("first_delivery_date").alias("first_delivery_month"), "is_shared_offer", "membership_type",
            "youngest_child_dob", "number_of_children", "expecting_at_sign_up", "item_mrr", "membership_mrr", "gross_mrr",
            "discount_offset", "net_mrr", F.col("basket_bin"), F.col("basket_ct").alias("initial_basket_ct"),
            F.col("basket_dollars").alias("initial_basket_dollars"),
            F.when(F.col("has_flagship") == 1, "YES").otherwise("NO").alias("initial_basket_has_flagship")))


# --- daily KPIs ------------------------------------------------------------

def _of_type(kinds: Sequence[str]) -> Column:
    return F.col("membership_type").isin(*kinds)


def member_steps(members: DataFrame, lead: str = "lead") -> DataFrame:
    """One row per member and status reached: date, status, type, label."""
    not_lead = F.col("member_status") != lead
    start, item = F.col("membership_start_dt"), F.col("first_item_order_dt")
    sent, back = F.col("first_delivery_dt"), F.col("last_pick_up_dt")
    reached = {
        "new": start, "scheduled": F.when(not_lead & (start <= item), item),
        "active": F.when(not_lead & (item <= sent), sent),
        "inactive": F.when(not_lead & (sent <= back), back), "lapsed": F.col("membership_end_dt")}
    steps = F.array(*[F.struct(F.lit(s).alias("status"), d.cast("date").alias("date")) for s, d in reached.items()])
    return members.select("membership_type", "member_status", F.explode(steps).alias("s")).select(
        "s.date", "s.status", "membership_type", "member_status").filter("date is not null")


def kpis_by_day(members: DataFrame, rentals: DataFrame, offsets: DataFrame, first: date | str, as_of: date | str,
                lapsed_labels: Mapping[str, str] = LAPSED_LABELS) -> DataFrame:
    """One row per day from `first` to `as_of` with all KPIs.

    Steps, rentals and offsets are each summed per day in one pass; running
    totals and growth then run on one row per day.  Changes before `first`
    are left out, as the reference's spine does.
    """
    spark = members.sparkSession
    steps = member_steps(members).groupBy("date").agg(
        *[F.count_if((F.col("status") == s) & _of_type(k)).alias(f"{s}{t}_members") for s in STATUSES for t, k in TYPES.items()],
        *[F.count_if((F.col("status") == "lapsed") & _of_type(k) & (F.col("member_status") == label)).alias(f"lapsed_{s}{t}_members")
          for s, label in lapsed_labels.items() for t, k in TYPES.items()])
    kinds = members.select("member_id", "membership_type")
    moves = lookup(rentals.select("member_id", "delivery_date", "pick_up_date", "avg_price"), kinds, "member_id")
    dated = F.explode(F.array(F.struct(F.lit("delivered").alias("move"), F.col("delivery_date").alias("date")),
                              F.struct(F.lit("picked_up").alias("move"), F.col("pick_up_date").alias("date"))))
    moves = moves.select("membership_type", "avg_price", dated.alias("m")).select("m.*", "membership_type", "avg_price").filter("date is not null")
    item_aggs = []
    for move in ("delivered", "picked_up"):
        for t, k in TYPES.items():
            hit = (F.col("move") == move) & _of_type(k)
            item_aggs.append(F.count_if(hit).alias(f"{move}{t}_items"))
            # The total MRR counts every rental, whatever its member's plan.
            value = (F.col("move") == move) if t == "" else hit
            item_aggs.append(F.coalesce(F.sum(F.when(value, F.col("avg_price"))), F.lit(0)).cast(MONEY).alias(f"{move}{t}_mrr"))
    moves = moves.groupBy("date").agg(*item_aggs)
    signs = F.explode(F.array(F.struct(F.col("start_date").alias("date"), F.col("discount_mrr_offset").alias("v")),
                              F.struct(F.col("end_date").alias("date"), (-F.col("discount_mrr_offset")).alias("v"))))
    offs = lookup(offsets, kinds, "member_id").select("membership_type", signs.alias("o")).select("o.*", "membership_type")
    offs = offs.groupBy("date").agg(*[
        F.coalesce(F.sum(F.col("v") if t == "" else F.when(_of_type(k), F.col("v"))), F.lit(0)).cast(MONEY).alias(f"discount_mrr_offset{t}")
        for t, k in TYPES.items()])
    out = day_spine(spark, first, as_of)
    for table in (steps, moves, offs):
        out = out.join(table, "date", "left")
    out = out.na.fill(0)
    return _with_totals(out)


def _with_totals(out: DataFrame) -> DataFrame:
    c = F.col
    along = Window.orderBy("date")  # one row per day
    running = along.rowsBetween(Window.unboundedPreceding, 0)
    annual, monthly = PLAN_PRICES[ANNUAL] / 12, float(PLAN_PRICES[MONTHLY])
    base = [x for x in out.columns if x != "date"]
    out = out.withColumns({f"{x}_cum": F.sum(x).over(running) for x in base})
    level = {}
    for s in STATUSES:
        level[f"{s}_annual_mrr"] = c(f"{s}_annual_members") * annual
        level[f"{s}_monthly_mrr"] = c(f"{s}_monthly_members") * monthly
        level[f"{s}_membership_mrr"] = c(f"{s}_annual_members") * annual + c(f"{s}_monthly_members") * monthly
    for t in TYPES:
        cum = lambda name: c(f"{name}{t}_members_cum")
        level[f"current_inactive{t}_members"] = cum("inactive") - cum("lapsed_inactive")
        level[f"current_active{t}_members"] = cum("active") - cum("inactive") - cum("lapsed_active")
        level[f"current_scheduled{t}_members"] = cum("scheduled") - cum("active") - cum("lapsed_scheduled")
        level[f"current_new{t}_members"] = cum("new") - cum("scheduled") - cum("lapsed_new")
        level[f"current{t}_members"] = cum("new") - cum("lapsed")
        level[f"active{t}_items"] = c(f"delivered{t}_items_cum") - c(f"picked_up{t}_items_cum")
        level[f"active{t}_rental_mrr"] = (c(f"delivered{t}_mrr_cum") - c(f"picked_up{t}_mrr_cum")).cast("double")
        level[f"active{t}_rental_mrr_net"] = (
            c(f"delivered{t}_mrr_cum") - c(f"picked_up{t}_mrr_cum") + c(f"discount_mrr_offset{t}_cum")).cast("double")
    level["new_annual_mrr_cum"] = c("new_annual_members_cum") * annual
    level["new_monthly_mrr_cum"] = c("new_monthly_members_cum") * monthly
    level["membership_mrr"] = c("new_annual_members_cum") * annual + c("new_monthly_members_cum") * monthly
    out = out.withColumns(level)
    plan = {"": "membership_mrr", "_annual": "new_annual_mrr_cum", "_monthly": "new_monthly_mrr_cum"}
    total = {}
    for t in TYPES:
        extra = c(plan[t]) if t in plan else F.lit(0.0)
        total[f"total{t}_mrr"] = c(f"active{t}_rental_mrr") + extra
        total[f"total{t}_mrr_net"] = c(f"active{t}_rental_mrr_net") + extra
        for n in (7, 30):
            total[f"current{t}_member_{n}d_growth_pct"] = growth(f"current{t}_members", F.lag(f"current{t}_members", n).over(along))
    return out.withColumns(total)


def kpi_long(kpis: DataFrame) -> DataFrame:
    """Current members as (date, member_type, member_status, member_count)."""
    entries = [
        F.struct(F.lit(t.lstrip("_") or "total").alias("member_type"), F.lit(label).alias("member_status"),
                 F.col(f"current_{s}{t}_members").alias("member_count"))
        for t in TYPES for s, label in LONG_NAMES.items()]
    return kpis.select("date", F.inline(F.array(*entries)))


# --- targets, waterfall, new customers -------------------------------------

def daily_targets(sheet: DataFrame, date_col: str = "date") -> DataFrame:
    """Text targets to numbers."""
    return sheet.select(parse_date(date_col).alias("date"), *[parse_number(c).alias(c) for c in sheet.columns if c != date_col])


# Target names and the sheet columns of each location.
TARGET_COLUMNS = {
    "SF": {"target_new": "gross_new_bay", "target_churn": "churn_bay", "target_total": "total_members_bay"},
    "NYC": {"target_new": "gross_new_nyc", "target_churn": "churn_nyc", "target_total": "total_members_nyc"},
}


def location_targets(sheet: DataFrame, columns: Mapping[str, Mapping[str, str]] = TARGET_COLUMNS) -> DataFrame:
    """One row per date and location from the wide target sheet."""
    rows = [F.struct(F.lit(place).alias("location"), *[parse_number(c).alias(t) for t, c in named.items()])
            for place, named in columns.items()]
    return sheet.select(parse_date("date").alias("date"), F.inline(F.array(*rows)))


def member_waterfall(members: DataFrame, targets: DataFrame) -> DataFrame:
    """New, churned, net and running members per location and day, and targets.

    targets: date, location, target_new, target_churn, target_total.  The
    running total counts all changes up to the day, listed in targets or not.
    """
    moves = F.explode(F.array(F.struct(F.col("membership_start_dt").cast("date").alias("date"), F.lit(1).alias("n")),
                              F.struct(F.col("membership_end_dt").cast("date").alias("date"), F.lit(-1).alias("n"))))
    per_day = members.select(F.col("ops_location").alias("location"), moves.alias("m")).select("location", "m.*").filter(
        "date is not null").groupBy("location", "date").agg(
        F.count_if(F.col("n") > 0).alias("actual_new"), (-F.count_if(F.col("n") < 0)).alias("actual_churn"))
    both = targets.join(per_day, ["date", "location"], "full_outer")
    w = Window.partitionBy("location").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)  # days per location
    new, churn = F.coalesce("actual_new", F.lit(0)), F.coalesce("actual_churn", F.lit(0))
    out = both.withColumn("actual_total", F.sum(new + churn).over(w)).join(
        targets.select("date", "location"), ["date", "location"], "left_semi")
    return out.select(
        "location", "date", new.alias("actual_new"), churn.alias("actual_churn"), (new + churn).alias("actual_net"),
        "target_new", "target_churn",
        (F.coalesce("target_new", F.lit(0.0)) + F.coalesce("target_churn", F.lit(0.0))).alias("target_net"),
        "actual_total", "target_total")


def new_customers(members: DataFrame, ledger: DataFrame, first: date | str, as_of: date | str) -> DataFrame:
    """Members by type on the day of their first transaction, zero-filled."""
    begun = ledger.groupBy("member_id").agg(F.min("transaction_ts").cast("date").alias("date"))
    groups = {"annual_members": (ANNUAL,), "monthly_members": (MONTHLY,), "other_members": (PER_ITEM, "influencer"),
              "gifters": ("gift-card-buyer",), "registry_buyers": ("registry-product-buyer",)}
    per_day = members.select("member_id", "membership_type").join(begun, "member_id").groupBy("date").agg(
        *[F.count_if(_of_type(k)).alias(n) for n, k in groups.items()])
    return day_spine(members.sparkSession, first, as_of).join(per_day, "date", "left").na.fill(0)


# --- monthly recurring revenue ---------------------------------------------

def month_mrr(rentals: DataFrame, members: DataFrame, first: date | str, as_of: date | str) -> DataFrame:
    """Items and MRR per member and month, for rentals out at the month's end.

    The end of a month is the first of the next, `as_of` for the month of it.
    """
    kinds = members.select("member_id", "first_name", "last_name", "membership_type")
    rows = expand_months(rentals.filter("member_id is not null").select("member_id", "delivery_date", "pick_up_date", "avg_price"),
                         "delivery_date", "pick_up_date", first, as_of)
    end = F.least(F.add_months("month", 1), day(as_of))
    rows = rows.filter((F.col("month") < day(as_of)) & (end > F.col("delivery_date")) & (F.col("pick_up_date").isNull() | (end < F.col("pick_up_date"))))
    per_month = rows.groupBy("member_id", "month").agg(
        F.count("avg_price").alias("item_count"), F.avg("avg_price").alias("avg_item_price"),
        F.coalesce(F.sum("avg_price"), F.lit(0)).cast(MONEY).alias("item_mrr"))
    out = per_month.join(kinds, "member_id").withColumn("membership_mrr", plan_mrr())
    return out.withColumn("total_mrr", F.col("item_mrr").cast("double") + F.col("membership_mrr"))


def mrr_pivot(monthly: DataFrame, months: Mapping[str, str]) -> DataFrame:
    """One row per member with item count and MRR columns per named month.

    months maps a column suffix to a month's first day.
    """
    aggs = [
        F.avg("total_mrr").alias("member_monthly_avg_mrr"), F.avg(F.col("item_mrr").cast("double")).alias("member_monthly_avg_item_mrr"),
        F.sum("total_mrr").alias("member_monthly_sum_mrr"), F.sum("item_mrr").cast(MONEY).alias("member_monthly_sum_item_mrr")]
    for name, first in months.items():
        hit = F.col("month") == day(first)
        aggs += [F.sum(F.when(hit, F.col("item_count"))).alias(f"items_{name}"),
                 F.sum(F.when(hit, F.col("item_mrr"))).cast(MONEY).alias(f"item_mrr_{name}"),
                 F.sum(F.when(hit, F.col("total_mrr"))).alias(f"total_mrr_{name}")]
    out = monthly.groupBy("member_id", "first_name", "last_name", "membership_type", "membership_mrr").agg(*aggs)
    return out.withColumns({
        f"avg_item_mrr_{n}": F.col(f"item_mrr_{n}").cast("double") / F.nullif(F.col(f"items_{n}"), F.lit(0)).cast("double") for n in months})


# Labels of the metric rows.
METRIC_ROWS = {"1. ITEM MRR": "item_mrr", "2. ITEM QTY": "items", "3. MRR/ITEM": "avg_item_mrr"}


def mrr_reshape(pivoted: DataFrame, months: Sequence[str]) -> DataFrame:
    """Three metric rows per member, members ranked by their item MRR.

    Member attributes stand on the first of the three rows only.
    """
    ranked = numbered_all(pivoted, [F.col("member_monthly_sum_item_mrr").desc_nulls_last(), F.col("member_id")], "cust_rank")
    rows = [F.struct(F.lit(label).alias("monthly_metric_type"), F.lit(i).alias("_pos"),
                     *[F.col(f"{metric}_{m}").cast("double").alias(m) for m in months])
            for i, (label, metric) in enumerate(METRIC_ROWS.items(), 1)]
    texts = ("first_name", "last_name", "membership_type")
    numbers = ("member_monthly_avg_mrr", "member_monthly_avg_item_mrr", "member_monthly_sum_mrr", "member_monthly_sum_item_mrr", "membership_mrr")
    out = ranked.select("member_id", "cust_rank", *texts, *numbers, F.inline(F.array(*rows)))
    top = F.col("_pos") == 1
    return out.select(
        "member_id", *[F.when(top, F.col(c)).otherwise("").alias(c) for c in texts], *[F.when(top, F.col(c)).alias(c) for c in numbers],
        "monthly_metric_type", *months, "cust_rank", ((F.col("cust_rank") - 1) * len(METRIC_ROWS) + F.col("_pos")).alias("row_order"))
