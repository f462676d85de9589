"""Date and number spines, interval expansion and its closed forms.

Intervals are [start, end) with a null end meaning open.  Expansion is local
to a row (`sequence` + `explode`), never a non-equi join.  Where only totals
are wanted, use `running_total` or `overlap_days`, which expand nothing.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from .exprs import RATE, col


def day(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def day_spine(spark: SparkSession, first: date | str, last: date | str, name: str = "date") -> DataFrame:
    """One row per day, both ends included."""
    days = F.explode(F.sequence(day(first), day(last)))
    return spark.range(1).select(days.alias(name))


def month_spine(spark: SparkSession, first: date | str, last: date | str, name: str = "month") -> DataFrame:
    months = F.sequence(F.trunc(day(first), "month"), day(last), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias(name))


def number_spine(spark: SparkSession, n: int, name: str = "ordinal") -> DataFrame:
    return spark.range(n).select(F.col("id").cast("int").alias(name))


def _last_day(end: Column, last: date | str) -> Column:
    return F.least(F.coalesce(F.date_sub(end, 1), day(last)), day(last))


def _first_day(start: str | Column, first: date | str | None) -> Column:
    start = col(start).cast("date")
    if first is None:
        return start
    # `greatest` skips nulls; an interval without a start must stay without one.
    return F.when(start.isNotNull(), F.greatest(start, day(first)))


def expand_days(df: DataFrame, start: str, end: str, last: date | str,
                first: date | str | None = None, name: str = "date") -> DataFrame:
    """One row per day of [start, end) up to `last`, from `first` on if given."""
    low = _first_day(start, first)
    high = _last_day(col(end).cast("date"), last)
    days = F.when(low <= high, F.sequence(low, high))
    return df.withColumn(name, F.explode(days))


def expand_months(df: DataFrame, start: str, end: str, first: date | str,
                  last: date | str, name: str = "month") -> DataFrame:
    """One row per month touched: start < month end and end >= month start."""
    low = F.trunc(_first_day(start, first), "month")
    high = F.trunc(F.least(F.coalesce(col(end).cast("date"), day(last)), day(last)), "month")
    months = F.when(low <= high, F.sequence(low, high, F.expr("interval 1 month")))
    return df.withColumn(name, F.explode(months))


def expand_units(df: DataFrame, quantity: str, name: str = "unit") -> DataFrame:
    """Repeat a row once per unit; null or non-positive quantities give no row."""
    n = col(quantity).cast("int")
    return df.withColumn(name, F.explode(F.when(n >= 1, F.sequence(F.lit(1), n))))


def overlap_days(start: str | Column, end: str | Column, first: date | str, last: date | str) -> Column:
    """Days of [start, end) that fall in first..last, both included."""
    days = F.datediff(_last_day(col(end).cast("date"), last), _first_day(start, first)) + 1
    return F.when(days > 0, days).otherwise(0)


def running_total(df: DataFrame, start: str, end: str, amount: str,
                  first: date | str, last: date | str,
                  by: tuple[str, ...] = (), name: str = "total") -> DataFrame:
    """Sum of `amount` over the intervals open on each day of first..last.

    Adds the amount on the start day, takes it off on the end day, sums the
    changes per day and accumulates them.  The window runs over days x `by`
    values only, however many intervals there are.
    """
    live = df.filter(col(start).isNotNull() & (col(end).isNull() | (col(end) > col(start))))
    change = F.explode(F.array(
        F.struct(col(start).cast("date").alias("date"), col(amount).cast(RATE).alias("change")),
        F.struct(col(end).cast("date").alias("date"), (-col(amount)).cast(RATE).alias("change")),
    ))
    changes = (
        live.select(*by, change.alias("c")).select(*by, "c.date", "c.change")
        .filter(F.col("date").isNotNull() & (F.col("date") <= day(last)))
        .groupBy(*by, "date").agg(F.sum("change").alias("change"))
    )
    groups = changes.select(*by).distinct() if by else df.sparkSession.range(1).select()
    grid = groups.withColumn("date", F.explode(F.sequence(day(first), day(last))))
    steps = (
        changes.unionByName(grid.withColumn("change", F.lit(0).cast("decimal(34,6)")))
        .groupBy(*by, "date").agg(F.sum("change").alias("change"))
    )
    w = Window.partitionBy(*by).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return (
        steps.withColumn(name, F.sum("change").over(w))
        .filter(F.col("date") >= day(first)).select(*by, "date", name)
    )
