"""Ad systems: campaigns, ads, their performance, and daily channel results.

Two ad systems are joined under hashed keys `md5('google-' || id)` and
`md5('facebook-' || id)`.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.calendar import day_spine
from ..functions.exprs import MONEY, blank_to_null, first_match, ratio, source_key
from .ordered import first_rows, lookup

SEARCH, SOCIAL = "google", "facebook"


def ad_kind(c: str) -> Column:
    kind = F.col(c)
    return first_match([(kind.ilike("%search%"), "adwords_search"), (kind.ilike("%image%"), "adwords_display")])


def dim_campaign(campaigns: DataFrame, ad_groups: DataFrame, ads: DataFrame, social_campaigns: DataFrame) -> DataFrame:
    """Campaigns of both systems with their channel."""
    groups = ad_groups.select(F.col("id").alias("ad_group_id"), F.col("campaign_id").alias("id"))
    kinds = ads.select("ad_group_id", ad_kind("type").alias("channel_id")).join(groups, "ad_group_id").groupBy("id").agg(
        F.max("channel_id").alias("channel_id"))
    search = campaigns.join(kinds, "id", "left").select(
        source_key(SEARCH, "id").alias("campaign_id"), F.col("id").alias("src_campaign_id"), F.col("name").alias("campaign_name"),
        F.col("start_date").alias("start_dt"), F.col("end_date").alias("end_dt"), "status", "channel_id")
    social = social_campaigns.select(
        source_key(SOCIAL, "id").alias("campaign_id"), F.col("id").alias("src_campaign_id"), F.col("name").alias("campaign_name"),
        F.col("start_time").alias("start_dt"), F.col("stop_time").alias("end_dt"), F.col("effective_status").alias("status"),
        F.lit("facebook_ads").alias("channel_id"))
    return search.unionByName(social)


def dim_ad(social_ads: DataFrame, ads: DataFrame, ad_groups: DataFrame, ad_key: DataFrame, account: str | None = None) -> DataFrame:
    """Ads of both systems; one key row per ad name.

    ad_key: ad_name, snoop, ny.  account limits the social ads to one account.
    """
    keys = first_rows(ad_key, "ad_name", ["snoop", "ny"])
    own = social_ads if account is None else social_ads.filter(F.col("account_id") == account)
    key = lambda source, c, name: source_key(source, c).alias(name)
    own = lookup(own.withColumnRenamed("name", "ad_name"), keys, "ad_name").select(
        key(SOCIAL, "id", "ad_id"), key(SOCIAL, "account_id", "ad_account_id"), key(SOCIAL, "campaign_id", "campaign_id"),
        key(SOCIAL, "adset_id", "audience_id"), F.lit("facebook").alias("ad_source"), "ad_name", "status",
        F.col("id").alias("source_ad_id"), F.col("campaign_id").alias("source_campaign_id"), "snoop", "ny")
    groups = ad_groups.select(F.col("id").alias("ad_group_id"), "campaign_id", F.col("name").alias("ad_name"))
    none = F.lit(None).cast("string")
    search = lookup(ads, groups, "ad_group_id").select(
        key(SEARCH, "id", "ad_id"), key(SEARCH, "adwords_customer_id", "ad_account_id"), key(SEARCH, "campaign_id", "campaign_id"),
        key(SEARCH, "ad_group_id", "audience_id"), ad_kind("type").alias("ad_source"), "ad_name", "status",
        F.col("id").alias("source_ad_id"), F.col("campaign_id").alias("source_campaign_id"), none.alias("snoop"), none.alias("ny"))
    return own.unionByName(search)


def fact_ad_performance(reports: DataFrame, ads: DataFrame, ad_groups: DataFrame, insights: DataFrame,
                        social_ads: DataFrame, account: str | None = None) -> DataFrame:
    """Spend (micros to units), impressions and clicks per report row."""
    groups = ad_groups.select(F.col("id").alias("ad_group_id"), "campaign_id")
    known = lookup(ads.select("id", "ad_group_id", "type"), groups, "ad_group_id").select(
        F.col("id").alias("ad_id"), "campaign_id", F.col("type").alias("ad_type"))
    search = lookup(reports, known, "ad_id").select(
        source_key(SEARCH, "id").alias("ad_performance_id"), source_key(SEARCH, F.when(F.col("ad_type").isNotNull(), F.col("ad_id"))).alias("ad_id"),
        F.col("date_start").cast("date").alias("date"), source_key(SEARCH, "campaign_id").alias("campaign_id"), "ad_type", "final_urls",
        (F.col("cost") / 1000000).cast(MONEY).alias("spend"), "impressions", "clicks")
    own = social_ads if account is None else social_ads.filter(F.col("account_id") == account)
    own = own.select(F.col("id").alias("ad_id"), "campaign_id", "url_parameters", F.lit(True).alias("_own"))
    social = insights.join(own, "ad_id", "left" if account is None else "inner").select(
        source_key(SOCIAL, "id").alias("ad_performance_id"), source_key(SOCIAL, F.when(F.col("_own"), F.col("ad_id"))).alias("ad_id"),
        F.col("date_start").cast("date").alias("date"), source_key(SOCIAL, "campaign_id").alias("campaign_id"),
        F.lit(None).cast("string").alias("ad_type"), F.col("url_parameters").alias("final_urls"),
        F.col("spend").cast(MONEY).alias("spend"), "impressions", F.col("link_clicks").alias("clicks"))
    return search.unionByName(social)


# Column prefix of each ad source in the daily report.
REPORT_SOURCES = {
    "facebook_sf": "facebook - SF", "facebook_ny": "facebook - NY",
    "google_search": "adwords_search", "google_display": "adwords_display",
}


def ad_spend_by_day(performance: DataFrame, ads: DataFrame, ad_key: DataFrame) -> DataFrame:
    """Spend, impressions and clicks per ad source and day, internal ads left out."""
    internal = ad_key.filter((F.col("snoop") == "yes") & blank_to_null("ad_name").isNotNull()).select("ad_name").distinct().withColumn("_internal", F.lit(True))
    named = lookup(performance.select("ad_id", "date", "spend", "impressions", "clicks"), ads.select("ad_id", "ad_source", "ad_name", "ny"), "ad_id")
    named = lookup(named, internal, "ad_name")
    social = F.coalesce(F.col("ad_source") == "facebook", F.lit(False))
    source = first_match([
        (social & (F.col("ny") == "yes"), "facebook - NY"),
        (social & ((F.col("ny") == "no") | F.col("ny").isNull()), "facebook - SF")], F.col("ad_source"))
    kept = named.filter(~(social & F.col("_internal").isNotNull()))
    return kept.groupBy(source.alias("ad_source"), "date").agg(
        F.sum("spend").cast(MONEY).alias("spend"), F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"))


def pivot_sources(spend: DataFrame, sources: Mapping[str, str] = REPORT_SOURCES) -> DataFrame:
    """One row per day: spend, impressions, clicks, CPM, CPC, CTR per source."""
    aggs = []
    for prefix, source in sources.items():
        for m in ("spend", "impressions", "clicks"):
            aggs.append(F.sum(F.when(F.col("ad_source") == source, F.col(m)).otherwise(0)).alias(f"{prefix}_{m}"))
    out = spend.groupBy("date").agg(*aggs)
    return out.withColumns({name: value for p in sources for name, value in _rates(p)})


def _rates(prefix: str):
    spend, seen, clicks = (F.col(f"{prefix}_{m}") for m in ("spend", "impressions", "clicks"))
    none = F.lit(0.0)  # a day without impressions or clicks has rate 0
    yield f"{prefix}_cpm", F.coalesce(ratio(spend.cast("double") * 1000, seen), none)
    yield f"{prefix}_cpc", F.coalesce(ratio(spend, clicks), none)
    yield f"{prefix}_ctr", F.coalesce(ratio(clicks, seen), none)


def funnel_by_day(web: DataFrame) -> DataFrame:
    """Sessions of new external visitors per day and how far they came."""
    kinds = {"adds_to_cart": "product_added", "product_viewed": "product_viewed", "checkout_started": "checkout_started", "order_completed": "order_completed"}
    # One row per session first: the day's counts are then plain sums.
    per_session = web.filter(~F.col("is_internal") & (F.col("membership_state") == "new")).groupBy(
        F.col("session_start_ts").cast("date").alias("date"), "session_id").agg(
        *[F.max(F.when(F.col("src_tbl") == k, 1).otherwise(0)).alias(n) for n, k in kinds.items()])
    return per_session.groupBy("date").agg(F.count(F.lit(1)).alias("sessions"), *[F.sum(n).alias(n) for n in kinds])


def channel_daily(web: DataFrame, spend: DataFrame, kpis: DataFrame, member_rows: DataFrame, orders: DataFrame,
                  first: date | str, as_of: date | str) -> DataFrame:
    """Marketing report per day: spend and rates per source, funnel, CAC.

    spend: `ad_spend_by_day`; kpis: `kpis_by_day`; member_rows: `member_agg`;
    orders: order fact.  CAC is (spend + discounts) / new members.
    """
    starts = member_rows.groupBy(F.col("membership_start_dt").alias("date")).agg(F.sum("first_order_flagship_only").alias("first_order_flagship_only"))
    off = orders.groupBy(F.col("order_ts").cast("date").alias("date")).agg(F.sum("order_discounts").cast(MONEY).alias("order_discounts"))
    out = day_spine(web.sparkSession, first, as_of)
    counts = kpis.select("date", "new_members", "new_annual_members", "new_monthly_members")
    for table in (pivot_sources(spend), funnel_by_day(web), counts, starts, off):
        out = out.join(table, "date", "left")
    zeros = [f"{p}_{m}" for p in REPORT_SOURCES for m in ("spend", "impressions", "clicks", "cpm", "cpc", "ctr")] + ["first_order_flagship_only"]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in zeros})
    out = out.withColumns({f"facebook_total_{m}": F.col(f"facebook_sf_{m}") + F.col(f"facebook_ny_{m}") for m in ("spend", "impressions", "clicks")})
    out = out.withColumns(dict(_rates("facebook_total")))
    paid = sum((F.col(f"{p}_spend") for p in REPORT_SOURCES), F.lit(0))
    out = out.withColumn("paid_marketing_spend", paid.cast(MONEY))
    return out.withColumns({
        "cost_per_atc": ratio("paid_marketing_spend", "adds_to_cart"), "paid_marketing_cac": ratio("paid_marketing_spend", "new_members"),
        "cac": ratio(F.col("paid_marketing_spend") + F.coalesce("order_discounts", F.lit(0).cast(MONEY)), "new_members")})
