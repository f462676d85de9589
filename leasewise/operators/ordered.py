"""Order-dependent building blocks that hold up when one key is very large.

A window over a whole key puts that key in one task.  These helpers avoid it:
"first rows" are cut before the shuffle, "is it the first row" is asked
of salted parts of a key and then of their first rows, and numbering or carrying a value along a key goes by
`split_hot`: keys with few rows take the plain window, the rows of a hot key are
cut into chunks of bounded size, each chunk is folded to one row, a window
along the key runs on those, and its result is joined to the chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from ..functions.exprs import col
from ..session import cut


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def solid_keys(df: DataFrame, keys: str | Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Key columns as text without nulls, and their names.

    A window and a join on these need one shuffle: a null-safe join on the
    keys themselves would shuffle again on other expressions.
    """
    keys = _keys(keys)
    names = [f"_solid_{k}" for k in keys]
    return df.withColumns({n: F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for n, k in zip(names, keys)}), names


def lookup(left: DataFrame, right: DataFrame, on: str | Sequence[str], spread: Sequence[str] = ()) -> DataFrame:
    """Left join of a fact to a keyed table.

    A null first key matches nothing.  Where many keys are null, `spread`
    names columns of the left side whose hash stands in for the key, so that
    such rows do not land in one partition; name columns that are read anyway.
    Text keys meet as they are: a copy of the key would be shuffled with every
    row, and the rows would be dealt anew for the next lookup by the same key.
    """
    keys = _keys(on)
    text = [df.schema[keys[0]].dataType == StringType() for df in (left, right)]
    if all(text) and not spread:
        rest = keys[1:]
        return left.join(right, keys, "left").select(
            *rest, *[F.col(f"`{c}`") for c in left.columns if c not in rest], *[F.col(f"`{c}`") for c in right.columns if c not in keys])
    probe = F.col(keys[0]).cast("string")
    if spread:
        probe = F.coalesce(probe, F.concat(F.lit("\u0000"), F.xxhash64(*spread).cast("string")))
    l = left.withColumn("_probe", probe)
    r = right.withColumn("_probe", F.col(keys[0]).cast("string")).drop(keys[0])
    return l.join(r, ["_probe", *keys[1:]], "left").drop("_probe")


def first_rows(df: DataFrame, keys: str | Sequence[str], order: Sequence[Column | str], n: int = 1) -> DataFrame:
    """First `n` rows per key; each map task keeps n rows per key at most."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def flag_first(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], name: str, salts: int = 64) -> DataFrame:
    """True on the first row of its key in `order`, which must end in a unique id.

    The input is read once and joined to nothing.  A first window runs along
    each of `salts` parts of a key; the first rows of these parts, `salts` of a
    key at most, then meet in one part of their own, while all others stay in
    theirs, so a hot key is never in one task.
    """
    def leads(part: str) -> Column:
        return F.row_number().over(Window.partitionBy(*_keys(keys), part).orderBy(*order)) == 1

    out = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(salts))).withColumn("_leads", leads("_part"))
    out = out.withColumn("_part", F.when(F.col("_leads"), F.lit(-1)).otherwise(F.col("_part")))
    return out.withColumn(name, F.col("_leads") & leads("_part")).drop("_part", "_leads")


HOT_ROWS = 1_000_000  # a key with more rows is cut into chunks
CHUNK_ROWS = 100_000  # rows of a chunk, at most


def split_hot(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
              hot_rows: int = HOT_ROWS, chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys with their `_chunk`); the second is None where no key is hot.

    `keys` hold no nulls (`solid_keys`).  One pass over the key columns counts
    their rows.  The rows of hot keys are range-partitioned by key and `order`,
    numbered where they then stand and written to the checkpoint folder, so
    that every later step sees the same chunks: at most `chunk_rows` rows each,
    whatever the key or the ties, in ascending order along a key.  There are
    fewer hot keys than rows / hot_rows, and the planner knows the written
    size, so it broadcasts them only where they are few.
    """
    keys = list(keys)
    hot = cut(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(*keys))
    if hot.isEmpty():
        return df, None
    order = [*keys, *order]
    chunks = cut(
        df.join(hot, keys, "left_semi").repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_chunk", F.floor(F.monotonically_increasing_id() / chunk_rows)))
    return df.join(hot, keys, "left_anti"), chunks


def before_chunk(keys: Sequence[str]) -> tuple[Window, Window, Window]:
    """Windows over one row per chunk: along a key, over its earlier and over its later chunks."""
    along = Window.partitionBy(*keys).orderBy("_chunk")
    return along, along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)


def numbered(df: DataFrame, keys: str | Sequence[str], ts: str, order: Sequence[str], name: str = "rn",
             hot_rows: int = HOT_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """`row_number` per key in order of (ts, *order)."""
    df, solid = solid_keys(df, keys)
    cold, hot = split_hot(df, solid, [ts, *order], hot_rows, chunk_rows)
    number = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(ts, *order)).cast("long")
    out = cold.withColumn(name, number(*solid))
    if hot is not None:
        sizes = hot.groupBy(*solid, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
        offsets = sizes.select(*solid, "_chunk", F.coalesce(F.sum("_n").over(before_chunk(solid)[1]), F.lit(0)).alias("_before"))
        placed = hot.withColumn(name, number(*solid, "_chunk")).join(offsets, [*solid, "_chunk"])
        out = out.unionByName(placed.withColumn(name, F.col(name) + F.col("_before")).drop("_chunk", "_before"))
    return out.drop(*solid)


def numbered_all(df: DataFrame, order: Sequence[Column | str], name: str = "rn") -> DataFrame:
    """`row_number` over the whole table without a one-task window.

    The table is range-partitioned, sorted and written to the checkpoint
    folder, which fixes the partitions; the offsets are one row per partition.
    """
    ranged = cut(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    inside = F.col("_pos") - F.shiftleft(F.col("_part").cast("long"), 33)
    return (
        ranged.join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(name, (inside + F.col("_before") + 1).cast("long"))
        .drop("_part", "_pos", "_before")
    )


def first_value(value: str | Column, ts: str, tie: str) -> Column:
    """Aggregate: first non-null value in order of (ts, tie)."""
    value = col(value)
    return F.min_by(value, F.when(value.isNotNull(), F.struct(ts, tie)))


def last_value(value: str | Column, ts: str, tie: str) -> Column:
    value = col(value)
    return F.max_by(value, F.when(value.isNotNull(), F.struct(ts, tie)))
