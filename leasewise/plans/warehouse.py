"""All models of the warehouse, each built from the ones before it.

A `Warehouse` takes the raw sources by name and a `Settings` object; every
model is a DataFrame built on first use.  Models that several others read are
`shared`: they go through `keep`, which writes them and goes on from the
written copy, so that no model drags the lineage of the whole warehouse along.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from ..operators import ads, attribution, commerce, identity, kpis, lifecycle, rentals, web
from ..session import check_tuned, cut_lean, cut_step, steps
from ..sources.tables import Expect, publish


@dataclass(frozen=True)
class Settings:
    """Business constants; dates are ISO text, `as_of` stands for today."""

    as_of: str
    first_day: str
    flagship_sku: str
    flagship_pattern: str
    influencer_pattern: str
    sharing_pattern: str
    bought_after: str = "2019-01-01"
    session_gap_s: int = 1800
    own_site: str = "shop.example.com"
    dev_site: str = "%-dev.%"
    internal_emails: Sequence[str] = ()
    sponsored: Mapping[str, str] = field(default_factory=dict)
    modules: Mapping[str, str] = field(default_factory=dict)
    ops_states: Sequence[tuple[str, Sequence[str]]] = lifecycle.OPS_STATES
    lapsed_labels: Mapping[str, str] = field(default_factory=lambda: kpis.LAPSED_LABELS)
    mrr_months: Mapping[str, str] = field(default_factory=dict)
    provinces: Mapping[str, int] = field(default_factory=dict)


def _kept(name: str, build: Callable[[], DataFrame]) -> DataFrame:
    with steps():
        return cut_lean(build())


class shared(cached_property):
    """A model that goes through `Warehouse.keep` when it is first built."""

    def __init__(self, build):
        super().__init__(lambda warehouse: warehouse.keep(build.__name__, lambda: build(warehouse)))


class Warehouse:
    def __init__(self, source: Callable[[str], DataFrame], settings: Settings,
                 keep: Callable[[str, Callable[[], DataFrame]], DataFrame] = _kept):
        """source: from a raw table name to its DataFrame.

        keep: from a shared model's name and builder to the written copy; by
        default a checkpoint.
        """
        self.source, self.settings, self.keep = source, settings, keep

    # --- identity ---
    @shared
    def idmap(self) -> DataFrame:
        s = self.source
        return identity.identity_map(s("customers"), s("contacts"), s("identifies"), s("landing_pages"), s("overrides"))

    @cached_property
    def emails(self) -> DataFrame:
        return identity.email_lookup(self.idmap)

    # --- commerce ---
    @cached_property
    def products(self) -> DataFrame:
        return commerce.dim_product(self.source("products"))

    @cached_property
    def prices(self) -> DataFrame:
        return commerce.sku_price(self.source("products"), self.source("variants"))

    @shared
    def lines(self) -> DataFrame:
        return commerce.fact_line_item(self.source("line_items"))

    @shared
    def membership_orders(self) -> DataFrame:
        s = self.source
        return commerce.membership_orders(s("line_items"), s("orders"), s("products"), s("customers"), self.idmap, self.prices)

    @shared
    def orders(self) -> DataFrame:
        gifts = commerce.gift_card_orders(self.source("line_items"), self.source("products"))
        return commerce.fact_order(self.source("orders"), self.idmap, self.membership_orders, gifts)

    @cached_property
    def refunds(self) -> DataFrame:
        return commerce.fact_refund(self.source("orders"), self.idmap)

    @cached_property
    def refund_lines(self) -> DataFrame:
        return commerce.fact_refund_line_item(self.refunds)

    @shared
    def ledger(self) -> DataFrame:
        return commerce.fact_transaction(self.orders, self.lines, self.refunds, self.refund_lines, self.products)

    @shared
    def special(self) -> DataFrame:
        return commerce.special_members(self.ledger)

    @cached_property
    def offsets(self) -> DataFrame:
        return commerce.discount_offsets(self.orders)

    @shared
    def order_baskets(self) -> DataFrame:
        return commerce.baskets_orders(self.orders, self.lines, self.products, self.settings.flagship_sku)

    @cached_property
    def addresses(self) -> DataFrame:
        return commerce.order_addresses(self.source("orders"))

    # --- rentals ---
    @shared
    def rentals(self) -> DataFrame:
        s = self.source
        return rentals.fact_rental(
            s("order_lines"), s("schedule_delivery"), s("pick_deliveries"), s("schedule_pickup"), s("ops_customers"),
            self.idmap, self.prices, self.products)

    @shared
    def items(self) -> DataFrame:
        s = self.source
        return rentals.dim_item(s("inventory"), s("associate_asset_tag"), s("sell_asset"), s("scrap_asset"))

    @cached_property
    def subscriptions(self) -> DataFrame:
        return rentals.dim_subscriptions(self.rentals)

    @shared
    def rental_baskets(self) -> DataFrame:
        return commerce.baskets_rentals(self.rentals, self.lines, self.orders, self.products, self.settings.flagship_sku)

    @cached_property
    def depreciation(self) -> DataFrame:
        c = self.settings
        return rentals.daily_depreciation(self.items, self.rentals, c.first_day, c.as_of)

    @cached_property
    def revenue(self) -> DataFrame:
        c = self.settings
        return rentals.daily_revenue(self.subscriptions, self.memberships, c.as_of, c.first_day)

    @cached_property
    def sku_agg(self) -> DataFrame:
        c = self.settings
        return rentals.sku_agg(self.products, self.items, self.rentals, c.as_of, c.first_day, c.bought_after)

    # --- lifecycle ---
    @cached_property
    def payments(self) -> tuple[DataFrame, DataFrame]:
        """`payment_agg` and `payment_inputs`, made of settled rows that are written once and then deleted."""
        c, s = self.settings, self.source
        codes = commerce.discount_codes(self.orders).filter(F.col("discount_code").ilike(c.influencer_pattern))
        group = lifecycle.flagship_skus(self.products, c.flagship_pattern)
        special = self.special
        with steps():
            last = cut_step(lifecycle.settled(self.ledger).select(*lifecycle.SETTLED))
            return (cut_lean(lifecycle.payment_agg(self.ledger, c.as_of, last=last)),
                    cut_lean(lifecycle.payment_inputs(self.ledger, self.lines, s("variants"), group, codes, special, c.as_of, last=last)))

    @cached_property
    def lifecycle_inputs(self) -> DataFrame:
        c = self.settings
        group = lifecycle.flagship_skus(self.products, c.flagship_pattern)
        # Each side is short once it is by member; written alone, its shuffle files are gone before the next one begins.
        rented = cut_lean(lifecycle.rental_inputs(self.rentals, group, c.as_of))
        return lifecycle.lifecycle_inputs(self.payments[1], rented)

    @shared
    def members(self) -> DataFrame:
        c, s = self.settings, self.source
        self.rentals  # noqa: B018 - the model with the longest steps is built while few others lie on disk
        return lifecycle.dim_members(
            lifecycle.contact_profile(s("contacts"), self.idmap, c.internal_emails),
            self.payments[0], self.lifecycle_inputs, self.orders, self.rentals,
            self.membership_orders, self.special, s("member_overrides"),
            lifecycle.shared_offer_members(s("orders"), self.idmap, c.sharing_pattern), self.idmap, c.as_of, c.ops_states)

    @cached_property
    def memberships(self) -> DataFrame:
        return lifecycle.dim_membership(self.members, self.settings.as_of)

    @cached_property
    def member_sales(self) -> DataFrame:
        return commerce.member_sales(self.ledger, self.members)

    # --- web ---
    @cached_property
    def campaigns(self) -> DataFrame:
        s = self.source
        return ads.dim_campaign(s("ad_campaigns"), s("ad_groups"), s("ads"), s("social_campaigns"))

    @shared
    def sessioned(self) -> DataFrame:
        known = identity.resolve_actor(self.source("events"), self.idmap)
        return web.sessionize(known, "master_user_id", "timestamp", "id", self.settings.session_gap_s)

    @shared
    def web(self) -> DataFrame:
        c, s = self.settings, self.source
        return web.enrich_sessions(
            self.sessioned, self.idmap, members=self.members, products=s("products"), campaigns=self.campaigns,
            clicks=s("clicks"), geo=s("geo"), exclusions=s("exclusions"), email_patterns=c.internal_emails,
            sponsored=c.sponsored, modules=c.modules, own_site=c.own_site, dev_site=c.dev_site)

    @cached_property
    def registry(self) -> DataFrame:
        return web.registry_agg(self.web, self.members)

    @cached_property
    def attribution(self) -> DataFrame:
        return attribution.member_attribution(self.members, self.web, self.settings.as_of)

    # --- marts ---
    @cached_property
    def customer_feed(self) -> DataFrame:
        return lifecycle.customer_feed(self.members, self.rentals, self.registry, self.idmap, self.settings.as_of)

    @shared
    def member_agg(self) -> DataFrame:
        c = self.settings
        return lifecycle.member_agg(
            self.members,
            lifecycle.web_summary(self.web, self.members, self.source("channels"), c.flagship_sku, f"%{c.own_site}/products/%"),
            lifecycle.rental_summary(self.rentals, c.flagship_sku, c.as_of),
            lifecycle.compare_baskets(self.order_baskets, self.rental_baskets),
            lifecycle.member_codes(self.orders), self.ledger, lifecycle.visit_gaps(self.rentals), c.as_of)

    @cached_property
    def cohorts(self) -> DataFrame:
        c = self.settings
        return kpis.cohort_base(self.rentals, self.members, self.offsets, commerce.nth_basket(self.rental_baskets, 1), c.first_day, c.as_of)

    @shared
    def kpis(self) -> DataFrame:
        c = self.settings
        return kpis.kpis_by_day(self.members, self.rentals, self.offsets, c.first_day, c.as_of, c.lapsed_labels)

    @cached_property
    def kpi_long(self) -> DataFrame:
        return kpis.kpi_long(self.kpis)

    @cached_property
    def new_customers(self) -> DataFrame:
        c = self.settings
        return kpis.new_customers(self.members, self.ledger, c.first_day, c.as_of)

    @cached_property
    def month_mrr(self) -> DataFrame:
        c = self.settings
        return kpis.month_mrr(self.rentals, self.members, c.first_day, c.as_of)

    @cached_property
    def mrr_pivot(self) -> DataFrame:
        return kpis.mrr_pivot(self.month_mrr, self.settings.mrr_months)

    @cached_property
    def waterfall(self) -> DataFrame:
        return kpis.member_waterfall(self.members, kpis.location_targets(self.source("daily_targets")))

    # --- ads ---
    @cached_property
    def ad_dim(self) -> DataFrame:
        s = self.source
        return ads.dim_ad(s("social_ads"), s("ads"), s("ad_groups"), s("ad_key"))

    @cached_property
    def ad_performance(self) -> DataFrame:
        s = self.source
        return ads.fact_ad_performance(s("ad_reports"), s("ads"), s("ad_groups"), s("social_insights"), s("social_ads"))

    @cached_property
    def channel_daily(self) -> DataFrame:
        c = self.settings
        spend = ads.ad_spend_by_day(self.ad_performance, self.ad_dim, self.source("ad_key"))
        return ads.channel_daily(self.web, spend, self.kpis, self.member_agg, self.orders, c.first_day, c.as_of)


# Reports that nothing else reads.
MARTS = ("memberships", "revenue", "depreciation", "sku_agg", "member_sales", "registry", "attribution", "customer_feed",
         "cohorts", "kpi_long", "new_customers", "mrr_pivot", "waterfall", "channel_daily", "ad_dim")


# Keys that a model must have on every row; a model without rows or with a null key is not published.
KEYS = {"orders": ("order_id",), "rentals": ("line_item_id",), "items": ("bin",), "members": ("member_id",), "kpis": ("date",), "web": ("id", "session_id")}


def write_models(source: Callable[[str], DataFrame], settings: Settings, database: str,
                 marts: Sequence[str] = MARTS) -> dict[str, DataFrame]:
    """The nightly build: shared models and marts as tables of a database of Spark's catalog.

    The session must have the settings of `leasewise.session.tune`.
    """
    check_tuned(source("customers").sparkSession)

    def write(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        keys = KEYS.get(name)
        with steps():
            return publish(build(), f"{database}.{name}", expect=Expect(least=1, not_null=keys) if keys else None)

    warehouse = Warehouse(source, settings, write)
    return {name: write(name, lambda: getattr(warehouse, name)) for name in marts}  # noqa: B023
