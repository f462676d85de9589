"""Tables for spreadsheets and operations apps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.exprs import iso_utc


def export(df: DataFrame, where: str | Column | None = None, order_by: Sequence[str] = ()) -> DataFrame:
    """Filtered and ordered copy of a table."""
    out = df if where is None else df.filter(where)
    return out.orderBy(*order_by) if order_by else out


def to_text(df: DataFrame, dest_cols: Sequence[str] | None = None) -> DataFrame:
    """All columns as text: ISO UTC times, true/false, blank for null and NaN.

    Only destination columns that the table has, in destination order.
    """
    names = df.columns if dest_cols is None else [c for c in dest_cols if c in df.columns]

    def text(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out = iso_utc(c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out = F.when(~F.isnan(c), c.cast("string"))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            out = F.to_json(c)
        else:
            out = c.cast("string")
        return F.coalesce(out, F.lit("")).alias(f.name)

    return df.select(*[text(df.schema[n]) for n in names])


def to_cells(df: DataFrame, column_ids: Mapping[str, int], row_id: str | None = None) -> DataFrame:
    """One JSON row per record: its cells as (columnId, value) pairs.

    Columns without an id are left out.  With `row_id` the row is an update of
    that destination row, else it goes to the bottom.
    """
    cells = F.array(*[
        F.struct(F.lit(i).cast("long").alias("columnId"), F.col(c).cast("string").alias("value"))
        for c, i in column_ids.items() if c in df.columns])
    head = F.lit("true").alias("toBottom") if row_id is None else F.col(row_id).alias("id")
    return df.select(F.to_json(F.struct(head, cells.alias("cells"))).alias("row"))


def freshness(tables: Mapping[str, DataFrame], ts_cols: Mapping[str, str], as_of: str) -> DataFrame:
    """Rows, latest change time and lag in seconds per table."""
    now, out = F.lit(as_of).cast("timestamp"), None
    for name, df in tables.items():
        latest = F.max(F.col(ts_cols[name]).cast("timestamp"))
        row = df.agg(F.count(F.lit(1)).alias("row_count"), latest.alias("latest_ts")).select(
            F.lit(name).alias("table_name"), "row_count", "latest_ts",
            (F.unix_timestamp(now) - F.unix_timestamp("latest_ts")).alias("lag_s"))
        out = row if out is None else out.unionByName(row)
    return out
