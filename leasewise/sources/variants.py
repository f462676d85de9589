"""JSON payloads parsed once: variant columns for fields, child rows, drift and profile.

`get_json_object` reads a payload once for every field taken from it.  Here a
payload becomes a variant in one projection; fields, children and the keys it
holds are then taken from its binary form.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

PARSED = "_variant"


def parsed(df: DataFrame, payload: str, into: str = PARSED) -> DataFrame:
    """The payload as a variant; malformed text is null, as is null."""
    return df.withColumn(into, F.try_parse_json(payload))


def fields(df: DataFrame, payload: str, wanted: Mapping[str, tuple[str, str]]) -> DataFrame:
    """The other columns and one for each `name: (path, type)` of the payload.

    A path is as `$.address.zip` or `$.lines[0].sku`.  Missing keys and values
    that do not fit the type are null; an object or array asked for as a
    string is its JSON text.
    """
    kept = [c for c in df.columns if c not in (payload, *wanted)]
    return parsed(df, payload).select(*kept, *[F.try_variant_get(PARSED, path, kind).alias(n) for n, (path, kind) in wanted.items()])


def children(df: DataFrame, payload: str, path: str, wanted: Mapping[str, tuple[str, str]], keep: Sequence[str]) -> DataFrame:
    """One row per element of an array in the payload: `keep`, the element's place from 0, and its wanted fields.

    Null, missing and empty arrays give no row, whatever their length nothing is cut off.
    """
    elements = parsed(df, payload).select(*keep, F.posexplode(F.try_variant_get(PARSED, path, "array<variant>")).alias("pos", "_element"))
    return elements.select(*keep, "pos", *[F.try_variant_get("_element", at, kind).alias(n) for n, (at, kind) in wanted.items()])


def keys(df: DataFrame, payload: str, path: str = "$", keep: Sequence[str] = ()) -> DataFrame:
    """(*keep, key, value) of the object at `path` in each payload; the value is a variant."""
    source = parsed(df, payload).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.try_variant_get(PARSED, path, "variant").alias("_at"))
    rows = df.sparkSession.sql("SELECT s.*, e.key, e.value FROM {source} AS s, LATERAL variant_explode(s._at) AS e WHERE e.key IS NOT NULL", source=source)
    return rows.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "key", "value")


def drift(df: DataFrame, payload: str, declared: Sequence[str] = (), path: str = "$") -> DataFrame:
    """Keys at `path` that are not declared: rows, a sample, and the type that holds all their values."""
    found = keys(df, payload, path).filter(~F.col("key").isin(*declared)) if declared else keys(df, payload, path)
    return found.groupBy("key").agg(
        F.count(F.lit(1)).alias("row_count"), F.min(F.try_variant_get("value", "$", "string")).alias("sample"),
        F.schema_of_variant_agg("value").alias("type"))


def profile(df: DataFrame, payload: str) -> DataFrame:
    """One row: payloads, those that are no JSON, and the merged type of all of them."""
    return parsed(df, payload).agg(
        F.count(payload).alias("payloads"), F.count_if(F.col(payload).isNotNull() & F.col(PARSED).isNull()).alias("malformed"),
        F.schema_of_variant_agg(PARSED).alias("type"))
