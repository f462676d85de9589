"""Checks on keys and row counts.  An empty result means the check holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def check_unique(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Non-null key values that occur more than once, with their count."""
    keys = [key] if isinstance(key, str) else list(key)
    return (
        df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )


def check_not_null(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows where any key column is null."""
    keys = [key] if isinstance(key, str) else list(key)
    test = F.lit(False)
    for k in keys:
        test = test | F.col(k).isNull()
    return df.filter(test)


def check_row_count(df: DataFrame, min_rows: int = 1, max_rows: int | None = None) -> bool:
    """True when the table has min_rows..max_rows rows; reads no more than needed."""
    if max_rows is None:
        return df.limit(min_rows).count() >= min_rows
    n = df.limit(max_rows + 1).count()
    return min_rows <= n <= max_rows


def key_report(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per (table, key): rows, null keys and repeated keys."""
    out = None
    for name, (df, key) in tables.items():
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        row = per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
            F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("repeated_keys"),
        ).select(F.lit(name).alias("table_name"), F.lit(key).alias("key_name"),
                 "row_count", "null_keys", "repeated_keys")
        out = row if out is None else out.unionByName(row)
    return out
