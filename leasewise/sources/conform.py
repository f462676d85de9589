"""Bring payload tables to their declared columns and types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import blank_to_null
from .spec import Field, TableSpec


def _typed(f: Field, c: Column) -> Column:
    if f.width is not None:
        c = F.substring(c.cast("string"), 1, f.width)
    if f.spark_type == "string":
        return c.cast("string")
    return blank_to_null(c.cast("string")).try_cast(f.spark_type)


def conform(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): rows cast to the declared types.

    A row is rejected when a non-blank value is lost in the cast; it keeps its
    values as text, with the names of the lost columns in `_lost`.
    """
    full = project_to_spec(df, spec, typed=False)
    lost = F.array_compact(F.array(*[
        F.when(blank_to_null(F.col(f.name).cast("string")).isNotNull() & _typed(f, F.col(f.name)).isNull(), F.lit(f.name))
        for f in spec.fields]))
    tested = full.withColumn("_lost", lost)
    good = tested.filter(F.size("_lost") == 0).select(*[_typed(f, F.col(f.name)).alias(f.name) for f in spec.fields])
    return good, tested.filter(F.size("_lost") > 0)


def project_to_spec(df: DataFrame, spec: TableSpec, typed: bool = True) -> DataFrame:
    """Declared columns in declared order; undeclared dropped, missing null."""
    present = set(df.columns)
    kind = lambda f: f.spark_type if typed else "string"
    return df.select(*[
        F.col(f.name) if f.name in present else F.lit(None).cast(kind(f)).alias(f.name) for f in spec.fields])


def resolve_aliases(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Each declared column from the first of its payload names that is set."""
    present = set(df.columns)
    out = []
    for f in spec.fields:
        found = [F.col(n) for n in f.payload_names if n.split(".")[0] in present]
        out.append((F.coalesce(*found) if found else F.lit(None).cast(f.spark_type)).alias(f.name))
    return df.select(*out)


def fill_missing(df: DataFrame, spec: TableSpec, default: object = None) -> DataFrame:
    """All declared columns, absent ones and nulls set to `default`."""
    full = project_to_spec(df, spec)
    return full if default is None else full.na.fill(default)


def schema_drift(df: DataFrame, payload: str, declared: Sequence[str]) -> DataFrame:
    """Keys of a JSON payload column that are not declared: rows and a sample."""
    pairs = df.select(F.explode(F.from_json(payload, "map<string,string>")).alias("key", "value"))
    return pairs.filter(~F.col("key").isin(*declared)).groupBy("key").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("value").alias("sample"))


# Candidate types of the profile, narrowest first.
CANDIDATES = ("int", "bigint", "double", "date", "timestamp", "boolean")


def profile_types(df: DataFrame, candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """Per text column: set values, how many fit each type, the proposed type.

    All columns are counted in one pass.  A bare number is no date, though a
    cast would take '2001' as one, nor is a day with a time, which a cast to
    date would cut off.
    """
    value = F.col("v")
    text = {"date": F.when(value.rlike(r"^\s*\d+-\d+-\d+\s*$"), value), "timestamp": F.when(value.contains("-"), value)}
    fits = lambda t: text.get(t, value).try_cast(t)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), blank_to_null(F.col(c).cast("string")).alias("v")) for c in df.columns])
    counts = df.select(F.inline(pairs)).groupBy("column_name").agg(
        F.count("v").alias("set_values"), *[F.count(fits(t)).alias(f"as_{t}") for t in candidates])
    best = None
    for t in candidates:
        all_fit = (F.col("set_values") > 0) & (F.col(f"as_{t}") == F.col("set_values"))
        best = F.when(all_fit, t) if best is None else best.when(all_fit, t)
    return counts.withColumn("proposed_type", best.otherwise("text"))
