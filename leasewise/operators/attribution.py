"""Credit conversions to the touches before them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from ..functions.exprs import epoch_second
from .ordered import CHUNK_ROWS, HOT_ROWS, before_chunk, solid_keys, split_hot

HOUR, DAY = 3600, 86400


def attribute(conversions: DataFrame, touches: DataFrame, lookback_h: int = 24 * 180, grace_h: int = 24,
              how: str = "left", slot_days: int = 30, keep: Sequence[str] = (), hot_rows: int = HOT_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per conversion and touch of its member in the time window.

    conversions: conversion_id, member_id, order_ts.  touches: event_id,
    member_id, event_ts, channel_id, campaign_id.  The window is
    [order_ts - lookback, order_ts + grace], both ends included.  Weights per
    conversion sum to 1: first touch, last touch, and shared (1; half each;
    or a quarter for the ends and the rest over the middle).  With
    how="left" a conversion without touches keeps one `direct` row.

    The join key is (member, slot of time): a conversion is repeated for the
    few slots of its window and a touch falls in one.  A slot that is large
    all the same is divided by AQE, as any skewed join is.
    """
    slot = slot_days * DAY
    # Count, first and last touch come from running counts, not from the pairs.
    stats = _in_windows(conversions, touches, lookback_h, grace_h, (), hot_rows, chunk_rows).select(
        "conversion_id", F.col("touches").alias("_n"), F.col("_first.id").alias("_first"), F.col("_last.id").alias("_last"))
    heads = conversions.select("conversion_id", "member_id", "order_ts", *keep).join(stats, "conversion_id", how)
    sec = epoch_second("order_ts")
    slots = F.sequence(F.floor((sec - lookback_h * HOUR) / slot), F.floor((sec + grace_h * HOUR) / slot))
    none = F.array(F.lit(None).cast("bigint"))  # a conversion without touches meets no slot and keeps its row
    wide = heads.withColumn("_slot", F.explode(F.when(F.col("_n").isNull(), none).otherwise(slots)))
    seen = touches.select("event_id", "member_id", "event_ts", "channel_id", "campaign_id").withColumn(
        "_slot", F.floor(epoch_second("event_ts") / slot))
    order_at, event_at = F.col("order_ts").cast("timestamp"), F.col("event_ts").cast("timestamp")
    rows = wide.join(seen, ["member_id", "_slot"], how).filter(
        F.col("_n").isNull() | (event_at <= order_at + F.expr(f"interval {grace_h} hours"))
        & (event_at >= order_at - F.expr(f"interval {lookback_h} hours"))).drop("_slot")
    alone = F.col("_n").isNull()
    first, last = alone | (F.col("event_id") == F.col("_first")), alone | (F.col("event_id") == F.col("_last"))
    one, zero = F.lit(1.0), F.lit(0.0)
    shared = (
        F.when(alone | (F.col("_n") <= 1), 1.0).when(F.col("_n") == 2, 0.5).when(first | last, 0.25)
        .otherwise(F.lit(0.5) / (F.col("_n") - 2.0)))
    return rows.select(
        "conversion_id", "member_id", "event_id", "order_ts", "event_ts",
        F.coalesce("channel_id", F.lit("direct")).alias("channel_id"),
        F.coalesce("campaign_id", F.lit("no campaign")).alias("campaign_id"), *keep,
        F.when(first, one).otherwise(zero).alias("first_touch_weighting"),
        F.when(last, one).otherwise(zero).alias("last_touch_weighting"), shared.alias("multi_touch_weighting"))


def member_touches(web: DataFrame) -> DataFrame:
    """Sessions of known members as touches."""
    return web.filter("member_id is not null").select(
        F.col("session_id").alias("event_id"), "member_id", F.col("session_start_ts").alias("event_ts"),
        F.col("session_channel_id").alias("channel_id"), F.col("session_campaign_name").alias("campaign_id"),
    ).distinct()


def member_attribution(members: DataFrame, web: DataFrame, as_of, **window) -> DataFrame:
    """Membership starts up to `as_of`, credited to the member's sessions."""
    starts = members.filter(F.col("membership_start_dt") <= F.lit(str(as_of)).cast("date")).select(
        F.col("member_id").alias("conversion_id"), "member_id", F.col("membership_start_dt").alias("order_ts"))
    return attribute(starts, member_touches(web), **window).drop("conversion_id")


def _orders(orders: DataFrame) -> DataFrame:
    return orders.filter("member_id is not null").select(F.col("order_id").alias("conversion_id"), "member_id", "order_ts")


def order_attribution(orders: DataFrame, web: DataFrame, lookback_h: int = 8760) -> DataFrame:
    """Orders credited to sessions of the year before: one row per order and session.

    No grace; orders without a session are left out.  The rows are the
    product of a member's orders and sessions in the window;
    `order_channel_credit` gives the sums per channel without them.
    """
    return attribute(_orders(orders), member_touches(web), lookback_h, 0, "inner").withColumnRenamed("conversion_id", "order_id")


def order_channel_credit(orders: DataFrame, web: DataFrame, lookback_h: int = 8760) -> DataFrame:
    """The credit of `order_attribution` per order and channel."""
    out = channel_credit(_orders(orders), member_touches(web), lookback_h, 0)
    return out.filter("touches > 0").withColumnRenamed("conversion_id", "order_id")


def _in_windows(conversions: DataFrame, touches: DataFrame, lookback_h: int, grace_h: int, by: Sequence[str] = (),
                hot_rows: int = HOT_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(conversion_id, *by, touches, _first, _last) of conversions with a touch in their window.

    Without a row per conversion and touch: the touches inside a window are
    the difference of two running counts, its ends the nearest touches to its
    bounds.  Touches and bounds of a member stand in one line of time; that of
    a hot member is cut into chunks, and one row per chunk carries counts and
    ends on.  With `by` (columns of the touches) all that holds per value.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    hour = HOUR * 1_000_000
    own = touches.filter("member_id is not null")
    seen = own.select(
        "member_id", *by, micros("event_ts").alias("_t"), F.lit(1).alias("_kind"),
        F.lit(None).cast(conversions.schema["conversion_id"].dataType).alias("conversion_id"),
        F.struct(micros("event_ts").alias("t"), F.col("event_id").alias("id")).alias("_touch"))
    # A window's lower bound sorts before touches at its time, the upper after.
    bounds = F.array(F.struct((micros("order_ts") - lookback_h * hour).alias("_t"), F.lit(0).alias("_kind")),
                     F.struct((micros("order_ts") + grace_h * hour).alias("_t"), F.lit(2).alias("_kind")))
    probes = conversions.filter("member_id is not null").select("member_id", F.explode(bounds).alias("b"), "conversion_id")
    if by:
        probes = probes.join(own.select("member_id", *by).distinct(), "member_id")
    line = seen.unionByName(probes.select("member_id", *by, "b._t", "b._kind", "conversion_id"), allowMissingColumns=True)
    line, keys = solid_keys(line, ["member_id", *by])
    order = [F.col("_t"), F.col("_kind"), F.col("_touch.id")]
    cold, hot = split_hot(line, keys, order, hot_rows, chunk_rows)

    def counted(rows: DataFrame, *group: str) -> DataFrame:
        """Bounds with the touches of the window up to them, the last of these and the next one."""
        w = Window.partitionBy(*group).orderBy(*order)
        upto, onward = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
        return rows.select(
            "*", F.count("_touch").over(upto).alias("_n"), F.last("_touch", ignorenulls=True).over(upto).alias("_back"),
            F.first("_touch", ignorenulls=True).over(onward).alias("_ahead")).filter("_kind <> 1")

    wanted = ["conversion_id", *by, "_kind", "_n", "_back", "_ahead"]
    found = counted(cold, *keys).select(*wanted)
    if hot is not None:
        folded = hot.groupBy(*keys, "_chunk").agg(F.count("_touch").alias("_count"), F.max("_touch").alias("_end"), F.min("_touch").alias("_begin"))
        _, earlier, later = before_chunk(keys)
        carried = folded.select(
            *keys, "_chunk", F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_sum"),
            F.last("_end", ignorenulls=True).over(earlier).alias("_before"), F.first("_begin", ignorenulls=True).over(later).alias("_after"))
        placed = counted(hot, *keys, "_chunk").join(carried, [*keys, "_chunk"]).withColumns({
            "_n": F.col("_n") + F.col("_sum"), "_back": F.coalesce("_back", "_before"), "_ahead": F.coalesce("_ahead", "_after")})
        found = found.unionByName(placed.select(*wanted))
    low, high = F.col("_kind") == 0, F.col("_kind") == 2
    return found.groupBy("conversion_id", *by).agg(
        (F.max(F.when(high, F.col("_n"))) - F.max(F.when(low, F.col("_n")))).alias("touches"),
        F.max(F.when(low, F.col("_ahead"))).alias("_first"),
        F.max(F.when(high, F.col("_back"))).alias("_last")).filter("touches > 0")


def channel_credit(conversions: DataFrame, touches: DataFrame, lookback_h: int = 24 * 180,
                   grace_h: int = 24, hot_rows: int = HOT_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Credit per conversion and channel, without a row per conversion and touch.

    Gives the sums of `attribute` when a member has many conversions, each
    with many touches; `direct` stands for touches without a channel.
    """
    named = touches.select("event_id", "member_id", "event_ts", F.coalesce("channel_id", F.lit("direct")).alias("channel_id"))
    per = _in_windows(conversions, named, lookback_h, grace_h, ["channel_id"], hot_rows, chunk_rows)
    whole = Window.partitionBy("conversion_id")  # its channels
    per = per.select(
        "*", F.sum("touches").over(whole).alias("_n"),
        (F.col("_first") == F.min("_first").over(whole)).cast("double").alias("first_touch"),
        (F.col("_last") == F.max("_last").over(whole)).cast("double").alias("last_touch"))
    ends = F.col("first_touch") + F.col("last_touch")
    shared = F.when(F.col("_n") <= 2, F.col("touches") / F.col("_n")).otherwise(
        ends * 0.25 + (F.col("touches") - ends) * F.try_divide(F.lit(0.5), F.col("_n") - 2.0))
    credited = per.select("conversion_id", "channel_id", "touches", "first_touch", "last_touch", shared.alias("multi_touch"))
    out = conversions.select("conversion_id", "member_id", "order_ts").join(credited, "conversion_id", "left")
    one = F.lit(1.0)
    return out.select(
        "conversion_id", "member_id", "order_ts", F.coalesce("channel_id", F.lit("direct")).alias("channel_id"), F.coalesce("touches", F.lit(0)).alias("touches"),
        *[F.coalesce(c, one).alias(c) for c in ("first_touch", "last_touch", "multi_touch")])


def credit(attributed: DataFrame, by: Sequence[str] = ("channel_id",)) -> DataFrame:
    """Weights summed per channel."""
    kinds = ("first_touch", "last_touch", "multi_touch")
    return attributed.groupBy(*by).agg(
        F.countDistinct("conversion_id").alias("conversions"),
        *[F.sum(f"{k}_weighting").alias(k) for k in kinds])
