"""Files there and back, payload shapes, refreshes, streams."""

import gzip
import os
import random
import uuid
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from leasewise.operators.web import sessionize
from leasewise.sources import conform, export, incremental, landing, payload
from leasewise.sources.spec import Field, TableSpec
from leasewise.sources.tables import KeyedTable
from leasewise.streaming import jobs

SPEC = TableSpec.of({"id": "int", "name": "varchar(5)", "price": "numeric", "day": "date", "seen": "timestamp", "ok": "bool"}, pk=("id",))


def test_landing_round_trip(spark, tmp_path):
    data = [(1, 'a "q", b', "1.50", date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), True), (2, "line\nbreak", None, None, None, None), (3, "", "2", None, None, False)]
    df = spark.createDataFrame(data, "id int, name string, price string, day date, seen timestamp, ok boolean")
    path = str(tmp_path / "land")
    landing.write_landing(df.coalesce(1), path, rows_per_file=2)
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 2 and all(f.endswith(".csv.gz") for f in parts)
    good, bad = landing.read_landing(spark, path, SPEC, multi_line=True)
    assert bad.count() == 0
    got = {r.id: r for r in good.collect()}
    assert got[1].name == 'a "q"' and str(got[1].price) == "1.50" and got[1].seen == datetime(2024, 1, 2, 3, 4, 5) and got[1].ok is True
    assert got[2].name == "line\n" and got[2].price is None and got[3].ok is False


def test_landing_rejects(spark, tmp_path):
    with gzip.open(tmp_path / "part-00000.gz", "wt") as f:
        f.write("1,a,1.0,2024-01-01,2024-01-01 00:00:00,true\nx,a,,,,\n2,b\n3,c,n/a,,,,extra\n4,d,,,2024-01-01T01:00:00-05:00,\n")
    good, bad = landing.read_landing(spark, str(tmp_path), SPEC)
    assert {r.id: r.seen for r in good.collect()} == {1: datetime(2024, 1, 1), 4: datetime(2024, 1, 1, 6)}
    assert bad.count() == 3 and bad.filter("_lost[0] = 'id'").count() == 1


def test_csv_encodings_and_seed(spark, tmp_path):
    (tmp_path / "latin.csv").write_bytes("name,n\nJos\xe9,1\n".encode("latin-1"))
    assert landing.read_csv(spark, str(tmp_path / "latin.csv"), encoding="ISO-8859-1").collect()[0].name == "José"
    (tmp_path / "seed.csv").write_bytes("﻿member_id,first_dt,flag\n007,2021-02-03,1\n008,,x\n".encode())
    seed = landing.read_seed(spark, str(tmp_path / "seed.csv"), {"first_dt": "date", "flag": "int"})
    assert rows(seed) == [("007", date(2021, 2, 3), 1), ("008", None, None)]


def test_write_csv(spark, tmp_path):
    df = spark.createDataFrame([('a "b"', 1, True), (None, None, None)], "s string, n int, b boolean").coalesce(1)
    text = lambda name: "".join(p.read_text() for p in sorted((tmp_path / name).iterdir()) if p.name.startswith("part-"))
    landing.write_csv(df, str(tmp_path / "o"), quote_text=True, header=True)
    assert text("o") == '"s","n","b"\n"a ""b""",1,"true"\n"","",""\n'
    landing.write_csv(df, str(tmp_path / "p"))
    assert text("p") == '"a ""b""",1,true\n,,\n'


def test_shapes(spark):
    df = spark.createDataFrame([(1, ("x", 2), [(5, "c")], ("r", "mail"))], "id int, properties struct<id:string,n:int>, items array<struct<item:int,order_id:string>>, reviewer struct<name:string,email:string>")
    assert rows(payload.flatten_struct(df.select("id", "properties"))) == [("x", 2)]
    assert payload.prefix_struct(df, "reviewer", ["name"], "reviewer_", ["items"]).columns == ["id", "properties", "reviewer_name"]
    assert rows(payload.explode_child(df, "items", "id", "order_id")) == [(5, 1)]
    assert payload.stringify_nested(df).collect()[0]["properties"] == '{"id":"x","n":2}'
    assert [payload.normalize_name(x) for x in ("Related  Order-Line #", "Record ID#")] == ["related_orderline_", "record_id"]
    roles = spark.createDataFrame([(1, ("a", "t1"), ("a", "t9")), (2, ("a", "t2"), None)], "n int, billing struct<id:string,town:string>, shipping struct<id:string,town:string>")
    assert rows(payload.role_addresses(roles, ["billing", "shipping"], ["n"])) == [("a", "t1", "billing"), ("a", "t9", "shipping")]
    wide = payload.union_events({"pages": df.select("id"), "clicks": spark.createDataFrame([("u",)], "url string")}, ["id", "url", "absent"])
    assert wide.columns == ["src_tbl", "id", "url", "absent"] and rows(wide, "src_tbl", "id", "url") == [("clicks", None, "u"), ("pages", 1, None)]


def test_melt_retention(spark):
    sheet = spark.createDataFrame([(0, "", "title", "", ""), (1, "", "Existing customers engagement", "2022-01-01", "2022-02-01"), (2, "1,000", "2021-12-01", "50%", ""), (3, "10", "2022-01-01", "100%", "5%"),
                                   (4, "", "", "", ""), (5, "9", "2020-01-01", "1%", "1%")], "row int, a string, b string, c string, d string")
    got = rows(payload.melt_retention(sheet, "row", ["a", "b", "c", "d"], ["2022-01-01", "2022-02-01"]), "cohort_month", "month", "engagement_pct", "expected_clients")
    assert [(g[2], g[3]) for g in got] == [(0.5, 500.0), (0.0, 0.0), (1.0, 10.0), (0.05, 0.5)]


def test_conform_aliases_defaults(spark):
    spec = TableSpec((Field("a", "int", ("x", "y")), Field("b", prefix="s"), Field("c", "float")))
    df = spark.createDataFrame([(None, 2, ("q",)), (1, 3, (None,))], "x int, y int, s struct<b:string>")
    assert rows(conform.resolve_aliases(df, spec)) == [(1, None, None), (2, "q", None)]
    filled = conform.fill_missing(spark.createDataFrame([(None,)], "b string"), TableSpec.of({"b": "text", "z": "text"}), "")
    assert rows(filled) == [("", "")]
    drift = conform.schema_drift(spark.createDataFrame([('{"a":1,"q":"z"}',), ("bad",), (None,)], "p string"), "p", ["a"])
    assert rows(drift) == [("q", 1, "z")]


def test_upsert_edges(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    batch = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z"), (None, "m")], "id int, v string")
    got = rows(incremental.upsert(target, batch, ["id"]))
    assert got == sorted([(1, "a"), (None, "n"), (2, "x"), (2, "y"), (3, "z"), (None, "m")], key=str)
    assert rows(incremental.upsert(target, batch.limit(0), ["id"])) == rows(target)
    with pytest.raises(ValueError):
        incremental.upsert(target, batch, [])


def test_marks(spark):
    empty = spark.createDataFrame([], "a timestamp, b timestamp")
    assert rows(incremental.high_water_mark(empty, ["a"])) == [(datetime(2019, 1, 1),)]
    df = spark.createDataFrame([(datetime(2020, 1, 1), datetime(2020, 5, 1)), (datetime(2020, 3, 1), None)], "a timestamp, b timestamp")
    assert rows(incremental.high_water_mark(df, ["a", "b"])) == [(datetime(2020, 5, 1),)] and rows(incremental.high_water_mark(df, ["a"])) == [(datetime(2020, 3, 1),)]
    assert rows(incremental.high_water_mark(df, ["a"], init=True)) == [(datetime(2019, 1, 1),)]
    assert incremental.incremental(df, "a", "2020-03-01", overlap_s=0).count() == 0 and incremental.incremental(df, "a", "2020-03-01").count() == 1


def test_times_are_utc_in_any_zone(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",)], "s string").select(F.col("s").cast("timestamp").alias("t"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert export.to_text(df).first().t == "2024-01-01T00:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_split_and_export(spark):
    ok, bad = incremental.split_status(spark.createDataFrame([("success", 1), ("fail", 2), (None, 3)], "status string, i int"))
    assert (rows(ok, "i"), rows(bad, "i")) == ([(1,)], [(2,), (3,)])
    df = spark.createDataFrame([(True, datetime(2024, 1, 1), float("nan"), None)], "b boolean, t timestamp, d double, s string")
    assert rows(export.to_text(df, ["t", "b", "d", "s", "gone"])) == [("2024-01-01T00:00:00Z", "true", "", "")]
    assert export.to_cells(df, {"s": 1, "b": 2}).collect()[0].row == '{"toBottom":"true","cells":[{"columnId":1},{"columnId":2,"value":"true"}]}'


def test_streams(spark, tmp_path):
    inbox, table = tmp_path / "in", KeyedTable(f"lw_stream_{uuid.uuid4().hex[:8]}", ("id",), 4)
    inbox.mkdir()
    spec = TableSpec.of({"id": "int", "v": "text", "at": "timestamp"})

    def run():
        good, bad = jobs.landing_stream(spark, str(inbox), spec)
        q = jobs.upsert_stream(good, table, "at", str(tmp_path / "cp")).trigger(availableNow=True).start()
        r = bad.writeStream.format("parquet").option("path", str(tmp_path / "bad")).option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
        assert q.awaitTermination(120) and r.awaitTermination(120)
        assert jobs.late_rows(q) == 0

    (inbox / "a.csv").write_text("1,old,2024-01-01 00:00:00\n1,new,2024-01-02 00:00:00\nx,bad,\n3,short\n")
    run()
    (inbox / "b.csv").write_text("2,two,2024-01-03 00:00:00\n")
    run()
    assert rows(table.read(spark), "id", "v") == [(1, "new"), (2, "two")]
    spark.sql(f"DROP TABLE {table.name}")
    bad = {r.id: r for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert bad["x"]["_lost"] == ["id"] and bad["3"]["_corrupt_record"] == "3,short"


def test_each_row_once_over_growing_files(spark, tmp_path):
    """Three runs; the second fails after its write and before the checkpoint is committed."""
    inbox, table, fail = tmp_path / "in", f"lw_stream_{uuid.uuid4().hex[:8]}", []
    land = lambda a, b: spark.range(a, b).select("id", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("at")).coalesce(2).write.mode("append").parquet(str(inbox))

    def run():
        rows_ = jobs.new_files(spark, str(inbox), "id long, at timestamp")
        jobs.append_once(rows_, table, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
        spark.catalog.refreshTable(table)

    land(0, 10)
    run()
    land(10, 30)
    plain = jobs._put

    def failing(*batch):
        plain(*batch)
        fail.append(1)
        raise RuntimeError("lost after the write")

    jobs._put = failing
    try:
        with pytest.raises(Exception, match="lost after the write"):
            run()
    finally:
        jobs._put = plain
    spark.catalog.refreshTable(table)
    assert fail and spark.table(table).count() == 30  # written, but the checkpoint does not know it
    run()
    assert rows(spark.table(table), "id") == sorted([(i,) for i in range(30)], key=str)
    land(30, 35)
    run()
    run()  # nothing new
    assert rows(spark.table(table), "id") == sorted([(i,) for i in range(35)], key=str)
    assert spark.table(table).select("_batch").distinct().count() == 3
    spark.sql(f"DROP TABLE {table}")


def test_stream_labels_events_like_the_batch_form(spark, tmp_path):
    """Files in any order within the delay, a run that fails before its mark, and late rows to their own table."""
    draw, sec, events = random.Random(4), 0, []
    for i in range(400):
        sec += draw.choice([0, 20, 200, 1700, 1800, 1801, 4000])
        events.append((draw.choice(["a", "b", None, "c"]), datetime(2024, 1, 1) + timedelta(seconds=sec), i))
    schema, table, inbox = "actor string, ts timestamp, id long", f"lw_labels_{uuid.uuid4().hex[:8]}", tmp_path / "in"
    files = [draw.sample(events[k:k + 50], len(events[k:k + 50])) for k in range(0, 400, 50)]
    for k in range(0, 8, 2):  # a fifth of each file comes with the next one
        files[k + 1] += files[k][:10]
        files[k] = files[k][10:]
    late = [("a", datetime(2024, 1, 1), 900), ("b", None, 901)]
    files[6] += late

    def run():
        stream = jobs.new_files(spark, str(inbox), schema, files_per_batch=1)
        jobs.session_labels(stream, table, str(tmp_path / "cp"), "actor", "ts", "id", 1800, 3600 * 24 * 3).trigger(availableNow=True).start().awaitTermination(240)

    plain = jobs._put

    def failing(rows_, name, batch_id):
        plain(rows_, name, batch_id)
        if name.endswith("_open"):
            raise RuntimeError("lost before the mark")

    for k, part in enumerate(files):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(inbox))
        if k == 3:
            jobs._put = failing
            with pytest.raises(Exception, match="lost before the mark"):
                run()
            jobs._put = plain
        run()
    want = rows(sessionize(spark.createDataFrame(events, schema), "actor", "ts", "id"), "id", "session_id")
    assert rows(jobs.labelled(spark, table, "actor", "ts", "id"), "id", "session_id") == want
    closed = spark.table(table).count()
    assert 100 < closed < 400 and rows(spark.table(f"{table}_late"), "id") == [(900,), (901,)]
    for name in (table, f"{table}_open", f"{table}_late", f"{table}_mark"):
        spark.sql(f"DROP TABLE {name}")


def test_session_stream(spark, tmp_path):
    events = [("a", datetime(2024, 1, 1, 0, 0)), ("a", datetime(2024, 1, 1, 0, 29)), ("a", datetime(2024, 1, 1, 2, 0)), ("b", datetime(2024, 1, 3))]
    spark.createDataFrame(events, "actor string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "ev"))
    stream = jobs.session_stream(spark.readStream.schema("actor string, ts timestamp").parquet(str(tmp_path / "ev")), "actor", "ts")
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = rows(spark.read.schema("actor string, session_start_ts timestamp, session_end_ts timestamp, event_count long").parquet(str(tmp_path / "out")), "actor", "event_count", "session_end_ts")
    assert got == [("a", 1, datetime(2024, 1, 1, 2, 0)), ("a", 2, datetime(2024, 1, 1, 0, 29))]
