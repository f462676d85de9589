"""Structured Streaming forms of sessionizing, landing, incremental loads and merges."""

from __future__ import annotations

import json
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from ..operators.web import sessionize
from ..session import cut
from ..sources.conform import conform
from ..sources.spec import TableSpec
from ..sources.tables import KeyedTable, dynamic_overwrite


def session_stream(events: DataFrame, actor: str, ts: str, gap_s: int = 1800, late: str = "1 hour") -> DataFrame:
    """Closed inactivity sessions per actor: start, end and event count.

    A pause of exactly `gap_s` stays in one session, as in the batch form.
    Spark ends a session `gap_s` after its last event; `session_end_ts` is the
    last event itself.
    """
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return timed.groupBy(F.session_window(ts, f"{gap_s} seconds").alias("w"), actor).agg(
        F.count(F.lit(1)).alias("event_count"), F.max(ts).alias("session_end_ts")
    ).select(actor, F.col("w.start").alias("session_start_ts"), "session_end_ts", "event_count")


def late_rows(query: StreamingQuery) -> int:
    """Rows that the watermark has dropped in the batches the query still reports.

    Spark has no side output for them: keep the raw events (they are files
    here) and run the batch form over the period when this is not 0.
    """
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in json.loads(p.json)["stateOperators"])


def landing_stream(spark: SparkSession, path: str, spec: TableSpec, files_per_batch: int = 1000) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) rows of headerless CSV parts as they land.

    Good rows have the declared types.  Rejected rows have lost a value in the
    cast (`_lost` names the columns) or have the wrong number of columns (the
    raw line is in `_corrupt_record`); start a query for each.
    """
    schema = spec.text_schema().add("_corrupt_record", "string")
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("escape", '"').option("columnPruning", False).csv(path)
    whole, broken = raw.filter("_corrupt_record is null"), raw.filter("_corrupt_record is not null")
    good, lost = conform(whole.drop("_corrupt_record"), spec)
    return good, lost.unionByName(broken, allowMissingColumns=True)


def new_files(spark: SparkSession, path: str, schema: StructType | str, form: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """The rows of files that have come since the last run: the query's checkpoint is the mark.

    In place of a latest change time, after which rows of the same second are
    read twice or not at all, the checkpoint names the files that were read.
    """
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(form).load(path)


BATCH = "_batch"


def _put(rows: DataFrame, table: str, batch_id: int) -> None:
    """Write a batch's own partition of a table, in place of what an earlier try has left there."""
    spark = rows.sparkSession
    marked = rows.withColumn(BATCH, F.lit(batch_id).cast("long"))
    if not spark.catalog.tableExists(table):
        marked.limit(0).write.partitionBy(BATCH).saveAsTable(table)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BATCH} = '{batch_id}')")
    with dynamic_overwrite(spark):
        marked.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def session_labels(events: DataFrame, table: str, checkpoint: str, actor: str, ts: str, event_id: str,
                   gap_s: int = 1800, late_s: int = 3600) -> DataStreamWriter:
    """Give each event of a stream its session: the id of the session's first event, as `sessionize` does.

    Events may come in any order within `late_s` of the latest time seen.  A
    session's events wait in `<table>_open` until no event on time can join it
    or come before it; then they go to `table` with their session_id.  Events
    before that bound, and those without a time, go to `<table>_late` as they
    are.  `<table>_mark` has the bound after each batch.  A batch reads what
    the one before has left and writes partitions of its own, the mark last,
    so a run that fails half-way is repeated without a row lost or doubled.
    An actor that never pauses waits whole.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        got = batch.withColumn(ts, F.col(ts).cast("timestamp"))
        held, bound = got.limit(0), None
        if spark.catalog.tableExists(f"{table}_mark"):
            before = spark.table(f"{table}_mark").filter(F.col(BATCH) < batch_id).agg(F.max_by("bound", BATCH), F.max(BATCH)).first()
            bound = before[0]
            held = spark.table(f"{table}_open").filter(F.col(BATCH) == (-1 if before[1] is None else before[1])).drop(BATCH).select(*got.columns)
        on_time = F.col(ts).isNotNull() & (F.lit(True) if bound is None else F.col(ts) >= F.lit(bound))
        _put(got.filter(~on_time), f"{table}_late", batch_id)
        # The pool is written once: sessions are cut in it, and its latest time moves the bound.
        pool = cut(held.unionByName(got.filter(on_time)))
        latest = pool.agg((F.max(ts) - F.expr(f"interval {late_s} seconds")).alias("b")).first()["b"]
        bound = max((b for b in (bound, latest) if b is not None), default=None)
        cutoff = F.lit(bound).cast("timestamp") - F.expr(f"interval {gap_s + 1} seconds")
        cut_in = sessionize(pool, actor, ts, event_id, gap_s)
        ends = cut_in.groupBy("session_id").agg(F.max(ts).alias("_end"))
        placed = cut(cut_in.join(ends, "session_id").withColumn("_closed", F.coalesce(F.col("_end") < cutoff, F.lit(False))))
        _put(placed.filter("_closed").select(*got.columns, "session_id"), table, batch_id)
        _put(placed.filter("not _closed").select(*got.columns), f"{table}_open", batch_id)
        _put(spark.range(1).select(F.lit(bound).cast("timestamp").alias("bound")), f"{table}_mark", batch_id)

    return events.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


def labelled(spark: SparkSession, table: str, actor: str, ts: str, event_id: str, gap_s: int = 1800) -> DataFrame:
    """All events so far with their session: the closed ones, and the open ones as they stand."""
    for name in (table, f"{table}_open", f"{table}_mark"):
        spark.catalog.refreshTable(name)
    last = spark.table(f"{table}_mark").agg(F.max(BATCH)).first()[0]
    waiting = spark.table(f"{table}_open").filter(F.col(BATCH) == last).drop(BATCH)
    return spark.table(table).drop(BATCH).unionByName(sessionize(waiting, actor, ts, event_id, gap_s))


def append_once(rows: DataFrame, table: str, checkpoint: str) -> DataStreamWriter:
    """Add each micro-batch to a catalog table exactly once; start it with `availableNow` for a nightly run.

    A batch has a partition of its own, written by an overwriting insert.  If
    a run ends between the write and the commit of the checkpoint, the next
    one gets the same files under the same number and replaces that partition.
    One table takes one checkpoint; `BATCH` stays in it as the load's number.
    A stream writes in a session of its own: call `spark.catalog.refreshTable`
    where the table was read before.
    """
    return rows.writeStream.foreachBatch(lambda batch, batch_id: _put(batch, table, batch_id)).option("checkpointLocation", checkpoint)


def upsert_stream(updates: DataFrame, table: KeyedTable, order: str, checkpoint: str) -> DataStreamWriter:
    """Merge each micro-batch into a keyed table, made by the first one; it rewrites the routes of the batch's keys only.

    Within a batch the row with the latest `order` wins.  A batch that is run
    again after a failure gives the same table, as its rows replace themselves.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        last = batch.groupBy(*table.key).agg(F.max_by(F.struct(*batch.columns), order).alias("r")).select("r.*")
        if batch.sparkSession.catalog.tableExists(table.name):
            table.merge(last)
        else:
            table.create(last)

    return updates.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
