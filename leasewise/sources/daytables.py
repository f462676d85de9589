"""Day tables that follow their intervals: only the periods a change touches are rebuilt.

A day table has a row per interval and day (depreciation, revenue).  When some
intervals change, the days whose rows differ are those that the old or the new
form of a changed interval covers; the table is partitioned by period (day or
month), and only these periods are computed and written again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.calendar import day
from .tables import dynamic_overwrite

PERIOD = "_period"
Range = tuple[date, date]  # first and last day


def touched_days(old: DataFrame, new: DataFrame, start: str, end: str, first: date | str, last: date | str,
                 key: Sequence[str] = (), old_last: date | str | None = None) -> DataFrame:
    """Distinct days of first..last on which the rows made of `old` and of `new` intervals may differ.

    Both have the same columns; intervals are [start, end), a null end is
    open.  Rows are compared as multisets: of a row that one side has more
    often, all days count.  With a `key`, unique on each side, a row whose end
    alone has changed counts only from the earlier to the later end.  Where
    the old table ended at `old_last`, the days after it count too.
    """
    columns = [c for c in new.columns if c not in (*key, end)] if key else new.columns
    side = lambda df, by: df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *([F.max(end).alias(end)] if key else []))
    by = [*key, *columns] if key else columns
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    both = side(old, by).alias("o").join(side(new, by).alias("n"), same, "full")
    low, high = day(first), day(last)
    stop = lambda c: F.coalesce(F.date_sub(c.cast("date"), 1), high)
    begin = F.coalesce(F.col(f"o.{start}"), F.col(f"n.{start}")).cast("date")  # an interval without one covers no day
    if key:
        ends = F.col(f"o.{end}").cast("date"), F.col(f"n.{end}").cast("date")
        met = F.col("o._n").isNotNull() & F.col("n._n").isNotNull()
        changed = ~met | ~ends[0].eqNullSafe(ends[1])
        from_ = F.when(met, F.greatest(begin, F.least(stop(ends[0]), stop(ends[1])) + 1)).otherwise(begin)
        to = F.when(met, F.greatest(stop(ends[0]), stop(ends[1]))).when(F.col("n._n").isNotNull(), stop(ends[1])).otherwise(stop(ends[0]))
    else:
        changed = ~F.col("o._n").eqNullSafe(F.col("n._n"))
        from_ = begin
        to = stop(F.when(F.col("n._n").isNotNull(), F.col(f"n.{end}")).otherwise(F.col(f"o.{end}")))
    spans = both.filter(changed).filter(begin.isNotNull()).select(F.greatest(from_, low).alias("a"), F.least(to, high).alias("b")).filter("a <= b").distinct()
    days = spans.select(F.explode(F.sequence("a", "b")).alias("date"))
    if old_last is not None:
        days = days.unionByName(old.sparkSession.range(1).select(
            F.explode(F.when(day(old_last) < high, F.sequence(F.greatest(F.date_add(day(old_last), 1), low), high))).alias("date")))
    return days.distinct()


def days_of(start: str, end: str, ranges: Sequence[Range], last: date | str, first: date | str | None = None):
    """The days of an interval that lie in the given ranges, as an array: for `explode`, in place of all its days."""
    low, high = F.col(start).cast("date"), F.least(F.coalesce(F.date_sub(F.col(end).cast("date"), 1), day(last)), day(last))
    if first is not None:
        low = F.when(low.isNotNull(), F.greatest(low, day(first)))
    parts = []
    for a, b in ranges:
        from_, to = F.when(low.isNotNull(), F.greatest(low, day(a))), F.least(high, day(b))
        parts.append(F.when(from_ <= to, F.sequence(from_, to)).otherwise(F.array().cast("array<date>")))
    return F.concat(*parts) if parts else F.array().cast("array<date>")


def overlapping(df: DataFrame, start: str, end: str, ranges: Sequence[Range]) -> DataFrame:
    """Intervals that may have a day in the ranges: a filter on plain columns, so that it reaches the scan."""
    if not ranges:
        return df.limit(0)
    return df.filter((F.col(start) <= day(max(b for _, b in ranges))) & (F.col(end).isNull() | (F.col(end) > day(min(a for a, _ in ranges)))))


@dataclass(frozen=True)
class DayTable:
    """A catalog table with a row per interval and day, partitioned by the day's period."""
    name: str
    date: str = "date"
    grain: str = "month"  # or "day"

    def __post_init__(self) -> None:
        if self.grain not in ("day", "month"):
            raise ValueError(f"no period {self.grain}")

    def _period(self, c):
        return c.cast("date") if self.grain == "day" else F.trunc(c, "month")

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PERIOD, self._period(F.col(self.date))).repartition(PERIOD)

    def create(self, df: DataFrame) -> DataFrame:
        self._placed(df).write.partitionBy(PERIOD).saveAsTable(self.name)
        return self.read(df.sparkSession)

    def build(self, spark: SparkSession, first: date | str, last: date | str, rows: Callable[[list[Range]], DataFrame]) -> DataFrame:
        """`create` from what `rows` makes of a range of days, one period after the other.

        Rows are written where they are made: none is shuffled or sorted by period.
        """
        low, high = date.fromisoformat(str(first)), date.fromisoformat(str(last))
        wanted = {self._start(low + timedelta(days=n)) for n in range((high - low).days + 1)}
        none = rows([(low, low)]).limit(0).withColumn(PERIOD, self._period(F.col(self.date)))
        none.write.partitionBy(PERIOD).option("compression", "zstd").saveAsTable(self.name)
        for period in sorted(wanted):
            self._fill(spark, period, rows)
        return self.read(spark)

    def _start(self, d: date) -> date:
        return d if self.grain == "day" else d.replace(day=1)

    def _fill(self, spark: SparkSession, period: date, rows: Callable[[list[Range]], DataFrame]) -> None:
        """Write a period anew; one without rows is dropped."""
        columns = [c for c in spark.table(self.name).columns if c != PERIOD]
        seen = Observation()
        made = rows([self._range(period)]).select(*columns).observe(seen, F.count(F.lit(1)).alias("rows"))
        spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({PERIOD} = DATE'{period}') SELECT * FROM {{made}}", made=made)
        if not seen.get.get("rows"):
            spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({PERIOD} = '{period}')")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name).drop(PERIOD)

    def periods(self, spark: SparkSession) -> list[date]:
        """The periods that hold rows, from the catalog."""
        return sorted(date.fromisoformat(r[0].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {self.name}").collect())

    def _range(self, period: date) -> Range:
        if self.grain == "day":
            return period, period
        return period, (period.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)

    def refresh(self, days: DataFrame, rows: Callable[[list[Range]], DataFrame]) -> list[Range]:
        """Rebuild the periods of the given days; `rows` makes all rows of the ranges it is given.  Returns these ranges.

        Days and periods are bounded by the calendar, so they come to the
        driver.  Months are written one after the other, as in `build`, days,
        which are many, in one write; a period that has no row any more is
        dropped.  What is written is counted in the same pass.  A refresh that
        is run again, also after a failure half-way, gives the same table.
        """
        spark = days.sparkSession
        wanted = sorted(r[0] for r in days.select(self._period(F.col(days.columns[0]))).distinct().collect())
        ranges: list[Range] = []
        for period in wanted:  # neighbours make one range
            a, b = self._range(period)
            if ranges and ranges[-1][1] + timedelta(days=1) == a:
                ranges[-1] = (ranges[-1][0], b)
            else:
                ranges.append((a, b))
        if not wanted:
            return []
        if self.grain == "month":
            for period in wanted:
                self._fill(spark, period, rows)
            return ranges
        columns = spark.table(self.name).columns
        seen = Observation()
        placed = self._placed(rows(ranges)).select(*columns).observe(seen, F.collect_set(PERIOD).alias("periods"))
        with dynamic_overwrite(spark):
            placed.write.insertInto(self.name, overwrite=True)
        written = set(seen.get["periods"] or [])
        for period in set(wanted) - written:
            spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({PERIOD} = '{period}')")
        return ranges

    def delete_from(self, spark: SparkSession, cutoff: date | str) -> None:
        """Delete the rows of the cutoff and later: whole periods through the catalog, the one it falls in is written again."""
        cutoff = date.fromisoformat(str(cutoff))
        for period in self.periods(spark):
            a, b = self._range(period)
            if a >= cutoff:
                spark.sql(f"ALTER TABLE {self.name} DROP PARTITION ({PERIOD} = '{period}')")
            elif b >= cutoff:
                kept = spark.table(self.name).filter((F.col(PERIOD) == day(period)) & (F.col(self.date) < day(cutoff)))
                if kept.isEmpty():
                    spark.sql(f"ALTER TABLE {self.name} DROP PARTITION ({PERIOD} = '{period}')")
                else:
                    with dynamic_overwrite(spark):
                        kept.write.insertInto(self.name, overwrite=True)
