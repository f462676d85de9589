"""Shape nested payloads: flatten, explode, unwrap, union, melt."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.exprs import blank_to_null
from ..operators.ordered import first_rows


def stringify_nested(df: DataFrame) -> DataFrame:
    """Struct, array and map columns as JSON text, others as they are."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields])


def flatten_struct(df: DataFrame, struct: str = "properties") -> DataFrame:
    """Fields of a struct as columns; on equal names the struct's field wins."""
    inner = [f.name for f in df.schema[struct].dataType.fields]
    outer = [c for c in df.columns if c != struct and c not in inner]
    return df.select(*outer, *[F.col(f"{struct}.{n}").alias(n) for n in inner])


def prefix_struct(df: DataFrame, struct: str, fields: Sequence[str], prefix: str, drop: Sequence[str] = ()) -> DataFrame:
    """Chosen fields of a struct as prefixed columns, bulky columns dropped."""
    out = df.withColumns({f"{prefix}{f}": F.col(f"{struct}.{f}") for f in fields})
    return out.drop(struct, *drop)


def explode_child(df: DataFrame, array: str, parent_key: str, as_: str) -> DataFrame:
    """One row per element of an array of structs, with the parent's key."""
    rows = df.select(F.col(parent_key).alias(as_), F.explode(array).alias("_child"))
    inner = [f.name for f in rows.schema["_child"].dataType.fields if f.name != as_]
    return rows.select(*[F.col(f"_child.{n}").alias(n) for n in inner], as_)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First-seen row per key, by an explicit order."""
    return first_rows(df, list(keys), order)


def role_addresses(df: DataFrame, roles: Sequence[str], order: Sequence[str], tag: str = "address_function") -> DataFrame:
    """Addresses embedded under several role columns, once per (role, id)."""
    rows = None
    for role in roles:
        part = df.filter(F.col(role).isNotNull()).select(*[F.col(c).alias(f"_o_{c}") for c in order], F.col(f"{role}.*"), F.lit(role).alias(tag))
        rows = part if rows is None else rows.unionByName(part)
    return first_rows(rows, [tag, "id"], [f"_o_{c}" for c in order]).drop(*[f"_o_{c}" for c in order])


def normalize_name(label: str) -> str:
    """'Related  Order-Line #' to 'related_orderline_': one '__' collapsed."""
    return re.sub(r"[^\w\s]", "", label).lower().replace(" ", "_").replace("__", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalize_name(c) for c in df.columns])


def unwrap_cells(df: DataFrame, payload: str, field_map: Mapping[str, str], file_fields: Sequence[str] = ()) -> DataFrame:
    """Columns from records of the form {field_id: {value: ...}}.

    A value that is an object gives its url for file fields, else its id.
    """
    cells = F.from_json(payload, "map<string,struct<value:string>>")
    out = df.withColumn("_cells", cells)

    def value(field_id, name):
        raw = F.try_element_at("_cells", F.lit(str(field_id)))["value"]
        inside = F.get_json_object(raw, "$.url" if name in file_fields else "$.id")
        return F.when(F.ltrim(raw).startswith("{"), inside).otherwise(raw).alias(name)

    return out.select(*[value(i, n) for i, n in field_map.items()])


def union_events(tables: Mapping[str, DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """All event tables under one layout, absent columns null, `src_tbl` added.

    With `columns`, the layout is that list, whatever the tables hold.
    """
    out = None
    for name, df in tables.items():
        kept = df if columns is None else df.select(*[c for c in df.columns if c in set(columns)])
        part = kept.withColumn("src_tbl", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if columns is not None:
        missing = [c for c in columns if c not in out.columns]
        out = out.withColumns({c: F.lit(None).cast("string") for c in missing}).select("src_tbl", *columns)
    return out


def children_of(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows of the parents just loaded."""
    return children.join(parents.select(key).distinct(), key, "left_semi")


def melt_retention(sheet: DataFrame, row: str, cells: Sequence[str], months: Sequence[str],
                   heading: str = "Existing customers engagement") -> DataFrame:
    """Cohort block of a sheet as (cohort_size, cohort_month, month, pct, expected).

    The block starts at the row whose second cell is `heading` and ends before
    the next row whose second cell is blank.  cells: size, cohort month, then
    one column per entry of `months`.
    """
    size, label, *values = cells
    start = sheet.filter(F.col(label) == heading).agg(F.min(row).alias("_start"))
    marked = sheet.join(F.broadcast(start), F.col(row) > F.col("_start"))  # one row
    stop = marked.filter(blank_to_null(F.col(label)).isNull()).agg(F.min(row).alias("_stop"))
    block = marked.join(F.broadcast(stop), F.col("_stop").isNull() | (F.col(row) < F.col("_stop")))  # one row
    named = block.select(F.col(size).alias("cohort_size"), F.col(label).alias("cohort_month"),
                         *[F.col(c).alias(m) for c, m in zip(values, months)])
    long = named.unpivot(["cohort_size", "cohort_month"], list(months), "month", "engagement_pct")
    share = F.coalesce(F.regexp_replace(blank_to_null("engagement_pct"), "%", "").try_cast("double"), F.lit(0.0)) / 100
    people = F.regexp_replace("cohort_size", ",", "").try_cast("double")
    return long.select(
        people.alias("cohort_size"), F.col("cohort_month").try_cast("date").alias("cohort_month"),
        F.col("month").try_cast("date").alias("month"), share.alias("engagement_pct"), (people * share).alias("expected_clients"))
