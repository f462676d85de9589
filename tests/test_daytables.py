"""Day tables that are rebuilt in part, and distinct counts that are merged."""

import random
import uuid
from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from leasewise.functions.calendar import expand_days
from leasewise.operators import distinct, rentals
from leasewise.sources.daytables import DayTable, days_of, overlapping, touched_days

D0 = date(2024, 1, 1)
FIRST, LAST = date(2024, 1, 5), date(2024, 6, 20)


def day(n):
    return D0 + timedelta(days=n)


def some_spans(draw, n):
    out = []
    for i in range(n):
        a = draw.randint(-40, 190)
        out.append((i, None if draw.random() < 0.03 else day(a), None if draw.random() < 0.2 else day(a + draw.randint(-3, 90)), draw.randint(1, 5)))
    return out


def plain_days(spans, last=LAST):
    """(day, id, value) of all spans."""
    out = []
    for i, a, b, v in spans:
        d = a
        while d is not None and d <= last and (b is None or d < b):
            if d >= FIRST:
                out.append((d, i, v))
            d += timedelta(days=1)
    return sorted(out, key=str)


SPANS = "id int, a date, b date, v int"


@pytest.mark.parametrize("key", [(), ("id",)])
@pytest.mark.parametrize("grain", ["day", "month"])
def test_refresh_equals_the_full_build(spark, key, grain):
    draw = random.Random(len(key))
    old = some_spans(draw, 40)
    new = [(i, a, b, v) for i, a, b, v in old if i % 9]  # some go
    new = [(i, a, day(draw.randint(0, 150)) if i % 5 == 0 else b, v + 1 if i % 11 == 0 else v) for i, a, b, v in new]  # ends and values change
    new = [(i, a and a + timedelta(days=2), b, v) if i == 13 else (i, a, b, v) for i, a, b, v in new] + [(100 + i, a, b, v) for i, a, b, v in some_spans(draw, 4)]
    old_last = date(2024, 6, 1)
    frame = lambda spans: spark.createDataFrame(spans, SPANS)
    table = DayTable(f"lw_days_{uuid.uuid4().hex[:8]}", "date", grain)
    try:
        table.create(expand_days(frame(old), "a", "b", old_last, FIRST).select("date", "id", "v"))
        assert rows(table.read(spark)) == plain_days(old, old_last)
        touched = touched_days(frame(old), frame(new), "a", "b", FIRST, LAST, key, old_last)
        differ = {d for d, *_ in set(plain_days(old, old_last)) ^ set(plain_days(new))}
        found = {r[0] for r in touched.collect()}
        assert differ <= found and min(found) >= FIRST and max(found) <= LAST
        if key:  # with a key no other days before the old end than those that differ, but for replaced values
            assert found - differ <= {day(n) for n in range(400) if day(n) > old_last} | {d for d, i, _ in plain_days(old, LAST) + plain_days(new) if i % 11 == 0 or i == 13}
        made = lambda ranges: overlapping(frame(new), "a", "b", ranges).withColumn("date", F.explode(days_of("a", "b", ranges, LAST, FIRST))).select("date", "id", "v")
        for _ in range(2):  # run again, the same
            table.refresh(touched, made)
            assert rows(table.read(spark)) == plain_days(new)
        assert table.periods(spark) == sorted({d if grain == "day" else d.replace(day=1) for d, *_ in plain_days(new)})
        table.delete_from(spark, "2024-03-10")
        assert rows(table.read(spark)) == [r for r in plain_days(new) if r[0] < date(2024, 3, 10)]
    finally:
        spark.sql(f"DROP TABLE {table.name}")


def test_only_touched_periods_are_computed_and_written(spark):
    spans = [(i, day(i), day(i + 5), 1) for i in range(170)]
    changed = [(i, a, b, 2 if i == 100 else v) for i, a, b, v in spans]
    old, new = (spark.createDataFrame(s, SPANS) for s in (spans, changed))
    table = DayTable(f"lw_days_{uuid.uuid4().hex[:8]}")
    try:
        table.create(expand_days(old, "a", "b", LAST, FIRST).select("date", "id", "v"))
        before = set(spark.table(table.name).inputFiles())
        asked = []
        touched = touched_days(old, new, "a", "b", FIRST, LAST, ["id"])
        assert {r[0] for r in touched.collect()} == {day(n) for n in range(100, 105)}

        def made(ranges):
            asked.extend(ranges)
            near = overlapping(new, "a", "b", ranges)
            assert near.count() == 34  # April's days and those that reach into it
            return near.withColumn("date", F.explode(days_of("a", "b", ranges, LAST, FIRST))).select("date", "id", "v")

        table.refresh(touched, made)
        after = set(spark.table(table.name).inputFiles())
        assert asked == [(date(2024, 4, 1), date(2024, 4, 30))]
        assert {f.split("_period=")[1].split("/")[0] for f in before ^ after} == {"2024-04-01"}
        assert rows(table.read(spark)) == plain_days(changed)
        assert table.refresh(touched.limit(0), made) == []
        with pytest.raises(ValueError):
            DayTable("x", grain="week")
    finally:
        spark.sql(f"DROP TABLE {table.name}")


def test_depreciation_and_revenue_follow_changed_rentals(spark):
    draw = random.Random(3)
    items = spark.createDataFrame([(f"b{i}", float(100 + i)) for i in range(12)], "bin string, p double").select("bin", F.col("p").cast("decimal(18,2)").alias("actual_purchase_price"))
    lent = [(f"b{i % 12}", f"m{i % 5}", "sku", day(draw.randint(0, 150)), None if i % 4 else day(draw.randint(150, 170)), 30.0) for i in range(30)]
    later = lent[2:] + [("b1", "m9", "sku", day(1), None, 45.0)]
    of = lambda r: spark.createDataFrame(r, "bin string, member_id string, sku string, delivery_date date, pick_up_date date, net_price double")
    name = f"lw_days_{uuid.uuid4().hex[:8]}"
    try:
        table = DayTable(f"{name}_d")
        old, new = (rentals.depreciation_spans(items, of(r), 60) for r in (lent, later))
        table.create(rentals.daily_depreciation(items, of(lent), FIRST, LAST, 60))
        rentals.refresh_depreciation(table, old, new, FIRST, LAST)
        want = rentals.daily_depreciation(items, of(later), FIRST, LAST, 60)
        assert rows(table.read(spark)) == rows(want) and rows(want) != rows(rentals.daily_depreciation(items, of(lent), FIRST, LAST, 60))
        subs = lambda r: of(r).select("member_id", "sku", F.col("delivery_date").alias("start_dt"), F.col("pick_up_date").alias("end_dt"), F.col("net_price").cast("decimal(18,2)").alias("net_price"))
        plans = spark.createDataFrame([("m1", "annual", day(3), None, 99.0)], "member_id string, membership_type string, start_dt date, end_dt date, p double").withColumn("price", F.col("p").cast("decimal(18,2)"))
        table = DayTable(f"{name}_r")
        before = date(2024, 6, 1)
        table.create(rentals.daily_revenue(subs(lent), plans, before, FIRST))
        rentals.refresh_revenue(table, rentals.revenue_intervals(subs(lent), plans), rentals.revenue_intervals(subs(later), plans), FIRST, LAST, before)
        assert rows(table.read(spark)) == rows(rentals.daily_revenue(subs(later), plans, LAST, FIRST))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}_d")
        spark.sql(f"DROP TABLE IF EXISTS {name}_r")


def test_distinct_counts_of_weeks_from_days(spark):
    draw = random.Random(8)
    data = [(day(draw.randint(0, 60)), draw.choice(["a", "b"]), None if draw.random() < 0.1 else f"u{draw.randint(0, 300)}", draw.random() < 0.2) for _ in range(3000)]
    df = spark.createDataFrame(data, "d date, kind string, who string, bought boolean")
    early, late = df.filter("d < date '2024-02-01'"), df.filter("d >= date '2024-02-01'")
    counted = {"visitors": "who", "buyers": F.when(F.col("bought"), F.col("who"))}
    ids = distinct.dense_ids(early, "who")
    kept = distinct.bitmaps(early, ["d", "kind"], counted, ids, "who")
    more = distinct.dense_ids(late, "who", ids)  # numbers given before stay
    assert rows(more)[:0] == [] and set(rows(ids)) <= set(rows(more)) and len({r[1] for r in rows(more)}) == more.count() == df.select("who").filter("who is not null").distinct().count()
    maps = kept.unionByName(distinct.bitmaps(late, ["d", "kind"], counted, more, "who"))
    for by in (["d", "kind"], [F.trunc("d", "week").alias("d")], [F.trunc("d", "month").alias("d"), "kind"], []):
        got = distinct.distinct_counts(maps, by, ["visitors", "buyers"])
        want = df.groupBy(*by).agg(F.countDistinct("who").alias("visitors"), F.countDistinct(F.when(F.col("bought"), F.col("who"))).alias("buyers")).filter("visitors > 0")
        assert rows(got) == rows(want)
        assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()


def test_build_writes_rows_where_they_are_made(spark, frame):
    """The table that `build` fills period by period is that of `create`; no plan of it deals rows by period."""
    items = frame([("x", 720.0), ("y", 360.0), ("z", 90.0)], "bin string, actual_purchase_price double").withColumn("actual_purchase_price", F.col("actual_purchase_price").cast("decimal(18,2)"))
    lent = frame([("x", "2001-01-20"), ("y", "2001-04-10"), ("y", None), ("z", None)], "bin string, delivery_date string").withColumn("delivery_date", F.col("delivery_date").cast("date"))
    names = [f"lw_built_{uuid.uuid4().hex[:8]}{x}" for x in "ab"]
    try:
        one = DayTable(names[0]).create(rentals.daily_depreciation(items, lent, "2001-01-01", "2001-06-01"))
        table = DayTable(names[1])
        spans = rentals.depreciation_spans(items, lent).localCheckpoint()
        two = rentals.build_depreciation(table, spans, "2001-01-01", "2001-06-01")
        assert rows(two) == rows(one) and one.count() == 133 + 53
        assert table.periods(spark) == DayTable(names[0]).periods(spark)
        made = rentals._depreciation_rows(spans, "2001-01-01", "2001-06-01")([(date(2001, 2, 1), date(2001, 2, 28))])
        assert made.count() == 28 and "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")
