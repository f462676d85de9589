"""Payloads as variants: parsed once, any shape."""

from conftest import rows
from pyspark.sql import functions as F

from leasewise.sources import variants

PAYLOADS = ['{"id": 7, "name": "a", "address": {"zip": "01", "geo": [1.5, 2]}, "lines": [{"sku": "x", "n": 2}, {"sku": "y"}]}',
            '{"id": "8", "name": null, "lines": [], "extra": true}', '{"id": 9.5, "lines": null, "extra": 3}', "[1, 2]", "not json", "", None, "null", '{"name": "b", "a.b": 1}']


def frame(spark):
    return spark.createDataFrame(list(enumerate(PAYLOADS)), "row int, payload string")


def test_fields(spark):
    wanted = {"id": ("$.id", "bigint"), "name": ("$.name", "string"), "zip": ("$.address.zip", "string"), "second": ("$.lines[1].sku", "string"), "geo": ("$.address.geo", "string")}
    got = variants.fields(frame(spark).withColumn("id", F.lit("clash")), "payload", wanted)
    assert got.columns == ["row", *wanted]
    none = (None,) * 4
    assert sorted(tuple(r) for r in got.collect()) == [
        (0, 7, "a", "01", "y", "[1.5,2]"), (1, 8, *none), (2, 9, *none), (3, None, *none), (4, None, *none), (5, None, *none), (6, None, *none), (7, None, *none), (8, None, "b", None, None, None)]


def test_payloads_are_parsed_once(spark):
    many = {f"f{i}": (f"$.f{i}", "string") for i in range(12)}
    plan = variants.fields(frame(spark), "payload", many)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") == 1


def test_children(spark):
    got = variants.children(frame(spark), "payload", "$.lines", {"sku": ("$.sku", "string"), "n": ("$.n", "int")}, ["row"])
    assert rows(got) == [(0, 0, "x", 2), (0, 1, "y", None)]
    long = spark.createDataFrame([("[" + ",".join(str(i) for i in range(7000)) + "]",)], "payload string").withColumn("row", F.lit(1))
    assert variants.children(long, "payload", "$", {"v": ("$", "int")}, ["row"]).agg(F.sum("v"), F.max("pos")).first()[:] == (7000 * 6999 // 2, 6999)


def test_drift_and_profile(spark):
    got = {r.key: (r.row_count, r.sample, r.type) for r in variants.drift(frame(spark), "payload", ["name", "lines", "address"]).collect()}
    assert got["extra"] == (2, "3", "VARIANT") and got["id"][:2] == (3, "7") and got["a.b"] == (1, "1", "BIGINT") and set(got) == {"extra", "id", "a.b"}
    inner = {r.key: r.row_count for r in variants.drift(frame(spark), "payload", (), "$.address").collect()}
    assert inner == {"zip": 1, "geo": 1}
    one = variants.profile(frame(spark).filter("row in (0, 4, 6)"), "payload").first()
    assert (one.payloads, one.malformed) == (2, 1) and "name: STRING" in one.type and "zip: STRING" in one.type
    assert variants.drift(frame(spark).limit(0), "payload", ["x"]).count() == 0
