"""Identity: one member id for a person across trackers, store and CRM."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.exprs import email_key
from .ordered import first_rows, lookup

# Source names written to the `src` column of the identity map.
TRACKER, STORE, CRM = "segment", "shopify", "hubspot"


def _with_member(df: DataFrame, src: str, overrides: DataFrame) -> DataFrame:
    """Add member_id: the override for (src, src_id), else the e-mail key."""
    forced = overrides.filter(F.col("src") == src).select("src_id", F.col("member_id").alias("_forced"))
    return (
        lookup(df, forced, "src_id")
        .withColumn("member_id", F.coalesce("_forced", "email_key")).drop("_forced")
    )


def identity_map(customers: DataFrame, contacts: DataFrame, identifies: DataFrame,
                 pages: DataFrame, overrides: DataFrame) -> DataFrame:
    """(src_id, src, email_key, member_id) for three systems.

    customers/contacts: id, email.  identifies/pages: anonymous_id, user_id,
    timestamp; the earliest mapping of an anonymous id wins.  overrides: src,
    src_id, member_id, one row per (src, src_id); merges several accounts.
    """
    def keyed(df):
        return df.select(F.col("id").cast("string").alias("src_id"), email_key("email").alias("email_key"))

    store = _with_member(keyed(customers), STORE, overrides)
    crm = _with_member(keyed(contacts), CRM, overrides)

    def seen(df):
        return df.select("anonymous_id", F.col("user_id").cast("string").alias("user_id"), "timestamp")

    # Reduce the logs to the earliest row per (anonymous id, user) first, so
    # that the join to customers sees each pair once.
    pairs = (
        seen(identifies).unionByName(seen(pages))
        .filter("anonymous_id is not null and user_id is not null")
        .groupBy("anonymous_id", "user_id").agg(F.min("timestamp").alias("timestamp"))
    )
    known = pairs.join(store.withColumnRenamed("src_id", "user_id"), "user_id")
    tracker = first_rows(known, "anonymous_id", ["timestamp", "email_key", "user_id"]).select(
        F.col("anonymous_id").alias("src_id"), "email_key", "member_id")

    def tagged(df, src):
        return df.select("src_id", F.lit(src).alias("src"), "email_key", "member_id")

    return tagged(tracker, TRACKER).unionByName(tagged(store, STORE)).unionByName(tagged(crm, CRM))


def ids_of(idmap: DataFrame, src: str, key: str, member: str = "member_id") -> DataFrame:
    """The part of the map for one source, with the id renamed to `key`."""
    return idmap.filter(F.col("src") == src).select(
        F.col("src_id").alias(key), F.col("member_id").alias(member))


def email_lookup(idmap: DataFrame) -> DataFrame:
    """Distinct (email_key, member_id); a key with several members fans out."""
    return idmap.select("email_key", "member_id").distinct()


def resolve_actor(events: DataFrame, idmap: DataFrame) -> DataFrame:
    """Add master_user_id: known member, else user id, else anonymous id."""
    by_device = ids_of(idmap, TRACKER, "anonymous_id", "_by_device")
    by_user = ids_of(idmap, STORE, "user_id", "_by_user")
    # Either key may be null on many events; the other one spreads them.
    out = lookup(lookup(events, by_device, "anonymous_id", ["user_id"]), by_user, "user_id", ["anonymous_id"])
    return out.withColumn(
        "master_user_id", F.coalesce("_by_device", "_by_user", "user_id", "anonymous_id")
    ).drop("_by_device", "_by_user")


def message_events(messages: DataFrame, emails: DataFrame) -> DataFrame:
    """Delivered / opened / clicked messages with the member of the address.

    Keeps link_url where the table has one.  A key with several members in
    `emails` gives one row per member.
    """
    extra = ["link_url"] if "link_url" in messages.columns else []
    keyed = messages.withColumn("email_key", email_key("context_traits_email"))
    return lookup(keyed, emails, "email_key", ["id"]).select(
        F.col("id").alias("event_id"), F.coalesce("member_id", "email_key").alias("member_id"),
        F.col("context_traits_email").alias("email"), F.col("timestamp").alias("event_ts"),
        "campaign_id", "campaign_name", *extra)


def capture_signups(identifies: DataFrame, members: DataFrame) -> DataFrame:
    """Addresses seen without a user id that also occur with one."""
    seen = identifies.filter("email is not null")
    anonymous = seen.filter("user_id is null or user_id = ''").select("email").distinct()
    known = seen.filter("user_id is not null").select("email", "user_id").distinct()
    starts = members.select("email", "membership_start_dt").distinct()
    return (
        known.join(anonymous, "email", "left_semi").join(starts, "email", "left")
        .select("email", "user_id", "membership_start_dt").distinct()
    )


def customers_crm(customers: DataFrame, contacts: DataFrame) -> DataFrame:
    """Customers with the id of the latest CRM contact of the same address."""
    named = contacts.filter("email is not null and email <> ''")
    latest = first_rows(named, "email", [F.col("updated_at").desc_nulls_last(), F.col("id").desc()])
    return lookup(customers, latest.select("email", F.col("id").alias("hubspot_id")), "email")
