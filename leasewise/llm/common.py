"""Reading the text tables and handing Arrow batches to a function."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

WORD = r"[^\x20\x09-\x0D]+"  # a word: anything between ASCII white space


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[str]]:
    """The rows with columns named c0, c1 and so on, and the new names of the needed ones.

    Operators that give all columns back add theirs to these, so that no name
    that comes in can clash; `named_back` undoes it.
    """
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), [f"c{docs.columns.index(n)}" for n in needed]


def named_back(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(columns)])


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about `most_bytes` of text each.

    A row is never cut, so a longer text makes a run of its own.
    """
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > most_bytes:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if len(lengths) > start:
        yield batch.slice(start)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches that end where a group ends, from rows sorted by the key columns (without nulls)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        ends = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns])) + 1
        same = held and all(held[-1].column(k)[-1].as_py() == c[0] for k, c in zip(keys, columns))
        if held and not same:
            yield pa.concat_batches(held)
            held = []
        if len(ends):
            yield pa.concat_batches([*held, batch.slice(0, ends[-1])])
            held = []
            batch = batch.slice(ends[-1])
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def group_starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
    return np.flatnonzero(np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])])


def by_text(docs: DataFrame, keep: list[str], text: str, schema: str,
            function: Callable[[list[str | None]], dict[str, pa.Array]], most_bytes: int = 4 << 20) -> DataFrame:
    """`keep` columns plus what `function` makes of each run of texts.

    Only the kept columns and the text go to Python, so other columns of any
    name do no harm.  `schema` has the new columns, in the order of the dict.
    """
    fields = [f.simpleString().replace(":", " ", 1) for f in docs.select(*keep).schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text", most_bytes):
                made = function(piece.column("_text").to_pylist())
                columns = {name: piece.column(f"_keep{i}") for i, name in enumerate(keep)} | made
                yield pa.RecordBatch.from_pydict(columns)

    packed = docs.select(*[docs[c].alias(f"_keep{i}") for i, c in enumerate(keep)], docs[text].alias("_text"))
    return packed.mapInArrow(run, ", ".join([*fields, schema]))
