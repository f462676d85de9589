"""Exact distinct counts that can be merged: dense ids and bitmaps.

`count(distinct)` of a week cannot be had from those of its days.  Here each
value gets a small whole number once, and a day keeps a bitmap of the numbers
it has seen; weeks and months are ORs of their days' bitmaps.  A bitmap row
covers 32,768 numbers, so no state grows with the data, and several counts in
one table need no Expand of its rows per count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import col
from .ordered import numbered_all


def dense_ids(values: DataFrame, value: str, known: DataFrame | None = None) -> DataFrame:
    """(value, id): a number from 1 for each distinct value; null has none.

    With `known`, numbers given before stay and new values get the next ones,
    so bitmaps kept from earlier days stay valid.
    """
    fresh = values.select(value).filter(F.col(value).isNotNull()).distinct()
    if known is None:
        return numbered_all(fresh, [value], "id")
    last = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_last"))  # one row
    new = numbered_all(fresh.join(known.select(value), value, "left_anti"), [value], "id")
    return known.select(value, "id").unionByName(new.crossJoin(F.broadcast(last)).select(value, (F.col("id") + F.col("_last")).alias("id")))


def bitmaps(rows: DataFrame, by: Sequence[str], counted: Mapping[str, str | Column], ids: DataFrame, value: str) -> DataFrame:
    """(*by, metric, bucket, bitmap) of the values that each count has seen.

    `counted` names the counts and gives the value that a row adds to each,
    or null.  The values of a row are stacked before the lookup of their ids,
    and equal ones of a group meet once.
    """
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), col(c).alias(value)) for n, c in counted.items()]))
    seen = rows.select(*by, stacked.alias("_s")).select(*by, "_s.metric", f"_s.{value}").filter(F.col(value).isNotNull()).distinct()
    numbered = seen.join(ids.select(value, "id"), value)
    return numbered.groupBy(*by, "metric", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))


def merged(maps: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Bitmaps of coarser groups, as weeks of days or tables that overlap."""
    return maps.groupBy(*by, "metric", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(maps: DataFrame, by: Sequence[str | Column], counted: Sequence[str]) -> DataFrame:
    """One row per group with each count: the bits of the merged bitmaps; 0 where a count has seen nothing."""
    columns = [c if isinstance(c, Column) else F.col(c) for c in by]
    whole = merged(maps, columns)
    names = whole.columns[:len(columns)]
    bits = F.bitmap_count("bitmap")
    return whole.groupBy(*names).agg(*[F.coalesce(F.sum(F.when(F.col("metric") == n, bits)), F.lit(0)).alias(n) for n in counted])
