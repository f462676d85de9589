"""Tables of the catalog: refreshes behind a view and merges into routed partitions."""

import random
import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from leasewise.operators.quality import check_row_count, check_unique
from leasewise.sources import incremental, tables
from leasewise.sources.tables import KeyedTable


@pytest.fixture
def name(spark):
    made = f"lw_{uuid.uuid4().hex[:10]}"
    yield made
    for r in spark.sql(f"SHOW TABLES LIKE '{made}*'").collect():
        kind = "VIEW" if spark.catalog.getTable(r.tableName).tableType == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} {r.tableName}")


def test_refresh_append_and_checks(spark, name):
    one = spark.createDataFrame([(1, "a")], "id int, v string")
    tables.publish(one, name)
    # A refresh may read the table it replaces.
    tables.publish(incremental.upsert(spark.table(name), spark.createDataFrame([(1, "b"), (2, "c")], "id int, v string"), ["id"]), name)
    assert rows(spark.table(name)) == [(1, "b"), (2, "c")]
    with pytest.raises(ValueError):
        tables.publish(one.unionByName(one), name, checks=[lambda df: check_row_count(df, 1), lambda df: check_unique(df, "id").isEmpty()])
    assert rows(spark.table(name)) == [(1, "b"), (2, "c")]
    assert tables.append(one.select("v", "id"), name).count() == 3
    for i in range(3):
        tables.publish(spark.createDataFrame([(i, "x")], "id int, v string"), name)
    assert rows(spark.table(name)) == [(2, "x")]
    kept = [r.tableName for r in spark.sql(f"SHOW TABLES LIKE '{name}__*'").collect()]
    assert len(kept) == 2  # this generation and the one before


def test_append_keeps_the_partitioning(spark, name):
    tables.publish(spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string"), name, partition_by=["p"])
    got = tables.append(spark.createDataFrame([("a", 3), ("c", 4)], "p string, id int"), name)
    assert rows(got, "id", "p") == [(1, "a"), (2, "b"), (3, "a"), (4, "c")]
    assert len({f.rsplit("/", 2)[-2] for f in got.inputFiles()}) == 3


def test_build_table(spark, name):
    one = spark.range(1)
    tables.build_table(spark, f"{name}_v", lambda: one, "view")
    tables.build_table(spark, f"{name}_t", lambda: one)
    assert spark.table(f"{name}_v").count() == spark.table(f"{name}_t").count() == 1
    with pytest.raises(ValueError):
        tables.build_table(spark, name, lambda: one, "other")
    tables.publish(one, f"{name}_t")
    spark.sql(f"DROP VIEW {name}_t")


ODD = ["a:b", "c/d", "x=y%z", "01", "1", None, "it's", "a b", "back\\slash", "é漢", "50%", "{p}"]


@pytest.mark.parametrize("routes", [1, 5])
def test_keys_move_between_partitions_with_any_value(spark, name, routes):
    """Every pair of odd values: a key leaves the one, which it may empty, for the other."""
    table = KeyedTable(name, ("id",), routes, ("p",))
    state = {i: ("v", p) for i, p in enumerate(ODD)}
    frame = lambda d: spark.createDataFrame([(i, v, p) for i, (v, p) in d.items()], "id int, v string, p string")
    table.create(frame(state))
    draw = random.Random(routes)
    for turn in range(4):
        batch = {i: (f"w{turn}", draw.choice(ODD)) for i in draw.sample(range(20), 7)}
        state |= batch
        for _ in range(2):  # a batch that is run again gives the same table
            got = table.merge(frame(batch))
            assert rows(got, "id", "v", "p") == sorted([(i, v, p) for i, (v, p) in state.items()], key=str)
    held = {(r[0], r[1]) for r in spark.table(name).select("_route", "p").distinct().collect()}
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == len(held)  # emptied ones are gone


def test_merge_reads_and_rewrites_only_its_routes(spark, name):
    table = KeyedTable(name, ("id",), 8)
    table.create(spark.range(1000).select(F.col("id").cast("int"), F.lit("v").alias("v")))
    route = dict(rows(spark.table(name), "id", "_route"))
    before = {f for f in spark.table(name).inputFiles()}
    batch = spark.createDataFrame([(3, "w"), (3, "w2"), (5000, "new"), (None, "null")], "id int, v string")
    table.merge(batch)
    touched = {r[0] for r in table._routed(batch).select("_route").collect()}
    kept = {f for f in before if int(f.split("_route=")[1].split("/")[0]) not in touched}
    assert kept and kept <= set(spark.table(name).inputFiles()) and not (before - kept) & set(spark.table(name).inputFiles())
    got = rows(table.read(spark))
    assert got == sorted([(i, "v") for i in route if i != 3] + [(3, "w"), (3, "w2"), (5000, "new"), (None, "null")], key=str)
    plan = spark.table(name).filter(F.col("_route").isin(list(touched)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_route" in plan.replace("isnotnull(_route", "_route") or "_route" in plan.split("PartitionFilters")[1][:80]


def test_replace_days(spark, name):
    """A key that is not unique: all rows of the days of the batch are replaced."""
    table = KeyedTable(name, ("day",), 4)
    table.create(spark.createDataFrame([("d1", 1), ("d1", 2), ("d2", 3)], "day string, n int"))
    assert rows(table.merge(spark.createDataFrame([("d1", 9), ("d3", 4)], "day string, n int"))) == [("d1", 9), ("d2", 3), ("d3", 4)]
    assert rows(table.merge(spark.createDataFrame([], "day string, n int"))) == [("d1", 9), ("d2", 3), ("d3", 4)]
    with pytest.raises(ValueError):
        KeyedTable(name, ())


def test_expectations_are_counted_in_the_write(spark, name):
    good = spark.range(5).select("id", (F.col("id") * 2).alias("n"))
    rule = tables.Expect(least=1, most=10, not_null=("id", "n"), where=("n >= id",))
    tables.publish(good, name, expect=rule)
    reads = []
    for bad, said in ((good.limit(0), "0 rows"), (spark.range(11).select("id", "id", F.col("id").alias("n")).select("n", F.col("n").alias("id")), "more than 10"),
                      (good.withColumn("n", F.when(F.col("id") < 3, F.col("n"))), "2 rows without n"), (good.withColumn("n", -F.col("id")), "4 rows without: n >= id")):
        with pytest.raises(ValueError, match=said):
            tables.publish(bad.select("id", "n"), name, expect=rule, checks=[lambda df: reads.append(df) or True])
    assert reads == []  # nothing that was written is read where the counts tell
    assert rows(spark.table(name)) == rows(good) and spark.sql(f"SHOW TABLES LIKE '{name}__*'").count() == 1
