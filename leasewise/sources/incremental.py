"""Marks, worklists and the new content of a refreshed table; `tables` writes it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from ..functions.exprs import greatest_of
from ..operators.ordered import numbered_all

FIRST_MARK = "2019-01-01"


# --- marks and worklists ---------------------------------------------------

def high_water_mark(df: DataFrame, audit_cols: Sequence[str], default: str = FIRST_MARK, init: bool = False) -> DataFrame:
    """One row: the latest change time, `default` when there is none."""
    first = F.lit(default).cast("timestamp")
    if init:
        return df.sparkSession.range(1).select(first.alias("mark"))
    latest = F.max(greatest_of([F.col(c).cast("timestamp") for c in audit_cols]))
    return df.agg(F.coalesce(latest, first).alias("mark"))


def incremental(df: DataFrame, audit_col: str, mark: str | datetime, overlap_s: int = 1) -> DataFrame:
    """Rows changed after the mark, and those of the last `overlap_s` seconds before it.

    Rows that share the time of the mark may have come after it was read, so
    they are read again; an upsert makes good for those already there.  With
    overlap_s=0 only rows after the mark.
    """
    bound = F.lit(str(mark)).cast("timestamp")
    if overlap_s:
        return df.filter(F.col(audit_col).cast("timestamp") >= bound - F.expr(f"interval {overlap_s} seconds"))
    return df.filter(F.col(audit_col).cast("timestamp") > bound)


def missing_keys(events: DataFrame, lookup: DataFrame, event_key: str, lookup_key: str,
                 since: str | None = None, ts: str | None = None) -> DataFrame:
    """Distinct event keys that the lookup does not hold."""
    recent = events if since is None else events.filter(F.col(ts) >= F.lit(since).cast("timestamp"))
    keys = recent.select(F.col(event_key).alias("key")).filter("key is not null").distinct()
    return keys.join(lookup.select(F.col(lookup_key).alias("key")), "key", "left_anti")


def assign_batches(df: DataFrame, key: str, size: int = 100) -> DataFrame:
    """Number the rows in key order into batches of `size`, from 0."""
    return numbered_all(df, [key], "_rn").withColumn("batch", F.floor((F.col("_rn") - 1) / size)).drop("_rn")


def split_status(df: DataFrame, status: str = "status", good: str = "success") -> tuple[DataFrame, DataFrame]:
    """(successes, errors) of an enrichment result; no status is an error."""
    ok = F.coalesce(F.col(status) == good, F.lit(False))
    return df.filter(ok), df.filter(~ok)


# --- new table content -----------------------------------------------------

def upsert(target: DataFrame, updates: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, and all rows of the batch."""
    if not pk:
        raise ValueError("upsert needs a key; without one it would empty the table")
    keys = updates.select(*pk).distinct()
    return target.join(keys, list(pk), "left_anti").unionByName(updates)


def replace_window(target: DataFrame, updates: DataFrame, window_fields: Sequence[str]) -> DataFrame:
    """Replace all rows whose window fields occur in the batch."""
    return upsert(target, updates, window_fields)


def delete_from(df: DataFrame, date_col: str, cutoff: str | date) -> DataFrame:
    """Rows before the cutoff; rows without a date stay."""
    c = F.col(date_col)
    return df.filter(c.isNull() | (c < F.lit(str(cutoff)).cast(df.schema[date_col].dataType)))


def changed_since(child: DataFrame, ts: str, bound: str, parent: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """Rows whose own, or whose parent's, change time is after the bound."""
    after = F.col(ts).cast("timestamp") > F.lit(bound).cast("timestamp")
    if parent is None:
        return child.filter(after)
    return child.join(parent.filter(after).select(key).distinct(), key, "left_semi")


def split_changes(df: DataFrame, existing: DataFrame, pk: Sequence[str], row_id: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """(inserts, updates); updates carry the row id of the destination."""
    known = existing.select(*pk, row_id).groupBy(*pk).agg(F.max(row_id).alias(row_id))
    marked = df.join(known, list(pk), "left")
    return marked.filter(F.col(row_id).isNull()).drop(row_id), marked.filter(F.col(row_id).isNotNull())
