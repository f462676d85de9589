"""Declared tables: ordered fields, keys, change columns, partitioning."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Declared type name -> Spark type.
TYPES = {
    "text": "string", "varchar": "string", "timestamp": "timestamp", "datetime": "timestamp", "date": "date",
    "int": "int", "bigint": "bigint", "float": "double", "numeric": "decimal(18,2)", "bool": "boolean", "boolean": "boolean",
}


@dataclass(frozen=True)
class Field:
    """One declared column.

    keys: payload names that may feed it, first non-null wins; the name itself
    when empty.  prefix: "struct." part put before each payload name.
    """

    name: str
    type: str = "text"
    keys: tuple[str, ...] = ()
    prefix: str | None = None

    @property
    def spark_type(self) -> str:
        base = re.match(r"\w+", self.type.lower()).group()
        return TYPES[base]

    @property
    def width(self) -> int | None:
        m = re.fullmatch(r"varchar\((\d+)\)", self.type.lower())
        return int(m.group(1)) if m else None

    @property
    def payload_names(self) -> tuple[str, ...]:
        names = self.keys or (self.name,)
        return tuple(f"{self.prefix}.{n}" for n in names) if self.prefix else names


@dataclass(frozen=True)
class TableSpec:
    fields: tuple[Field, ...]
    pk: tuple[str, ...] = ()
    audit_cols: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    replace_keys: tuple[str, ...] = field(default=())

    @classmethod
    def of(cls, columns: dict[str, str], **options) -> "TableSpec":
        return cls(tuple(Field(n, t) for n, t in columns.items()), **options)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])
