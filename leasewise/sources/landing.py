"""Read and write landed files: CSV parts, seeds, sheets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .conform import conform
from .spec import TableSpec

ROWS_PER_FILE = 10_000
BOM = "﻿"


def read_landing(spark: SparkSession, path: str, spec: TableSpec, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) rows of headerless CSV parts, plain or gzip.

    Columns are taken by position.  Over-wide text is cut to its declared
    width; a row with too few or too many columns is rejected with its raw
    line in `_corrupt_record`.  multi_line: values may hold line ends, which
    makes each plain file one task.
    """
    schema = spec.text_schema().add("_corrupt_record", T.StringType())
    raw = spark.read.schema(schema).option("mode", "PERMISSIVE").option("escape", '"').option(
        "multiLine", multi_line).option("emptyValue", "").option("columnPruning", False).csv(path)
    # Spark refuses to read the corrupt-record column alone, so the test takes
    # in the other columns as well; its second part is always true.
    read = F.length(F.concat_ws("", *spec.names)) >= 0
    whole = raw.filter(F.col("_corrupt_record").isNull() & read)
    broken = raw.filter(F.col("_corrupt_record").isNotNull() & read)
    good, lost = conform(whole.drop("_corrupt_record"), spec)
    return good, lost.unionByName(broken, allowMissingColumns=True)


def read_csv(spark: SparkSession, path: str, header: bool = True, encoding: str = "UTF-8",
             schema: str | T.StructType | None = None) -> DataFrame:
    """CSV with a header; bytes that are no text in `encoding` are replaced."""
    reader = spark.read.option("header", header).option("encoding", encoding).option("escape", '"')
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    return strip_bom(df)


def read_seed(spark: SparkSession, path: str, types: Mapping[str, str] | None = None) -> DataFrame:
    """Small CSV with a header; listed columns get their type, others text."""
    df = read_csv(spark, path)
    types = types or {}
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def strip_bom(df: DataFrame) -> DataFrame:
    first = df.columns[0]
    return df.withColumnRenamed(first, first.lstrip(BOM)) if first.startswith(BOM) else df


def clean_sheet(df: DataFrame, row: str, skip: int = 1, drop_markers: Sequence[str] = (),
                columns: Mapping[str, int] | None = None) -> DataFrame:
    """Body of a sheet: header rows and marker rows dropped, columns picked.

    `row` holds the 0-based sheet row, so that the result does not depend on
    how the file is split.  columns maps a name to a column position.
    """
    cells = [c for c in df.columns if c != row]
    body = df.filter(F.col(row) >= skip)
    if drop_markers:
        body = body.filter(~F.coalesce(F.col(cells[0]).isin(*drop_markers), F.lit(False)))
    if columns is None:
        return body.select(row, *cells)
    return body.select(row, *[F.col(cells[i]).alias(name) for name, i in columns.items()])


def write_landing(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Headerless gzip CSV parts of at most `rows_per_file` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("compression", "gzip").option(
        "escape", '"').option("emptyValue", "").csv(path)


def write_csv(df: DataFrame, path: str, quote_text: bool = False, header: bool = False) -> None:
    """CSV parts; quote_text puts quotes around all values but numbers, nulls as empty text."""
    if not quote_text:
        df.write.mode("overwrite").option("header", header).option("escape", '"').csv(path)
        return
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    cells = [F.coalesce(F.col(f.name).cast("string"), F.lit('""')) if isinstance(f.dataType, T.NumericType) else quoted(F.col(f.name).cast("string")) for f in df.schema.fields]
    line = F.concat_ws(",", *cells).alias("value")
    if header:  # one line at the head of each part, as the CSV writer does
        names = ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        line = F.when(first, F.concat(F.lit(names + "\n"), line)).otherwise(line).alias("value")
    df.select(line).write.mode("overwrite").text(path)
