"""Tables in Spark's catalog: checked refreshes behind a view, and merges by key into routed partitions.

Everything is written by Spark's own table writers.  A table that is replaced
as a whole is a view on its latest generation, so readers never see half of it
and a refresh may read what it replaces.  A table that takes keyed batches has
a hash of the key as its first partition column: the keys of a batch name the
partitions to rewrite, and no other is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

ROUTE = "_route"


# --- whole tables ----------------------------------------------------------

def _generation(spark: SparkSession, name: str) -> str | None:
    """The table that the view `name` stands for."""
    if not spark.catalog.tableExists(name):
        return None
    said = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if "View Text" not in said:
        raise ValueError(f"{name} is a table; publish makes a view")
    return said["View Text"].removeprefix("SELECT * FROM ")


@dataclass(frozen=True)
class Expect:
    """What the rows of a write have to be; counted while they are written, so nothing is read again."""
    least: int | None = None
    most: int | None = None
    not_null: tuple[str, ...] = ()
    where: tuple[str, ...] = ()  # SQL conditions that hold on every row

    def metrics(self) -> list[Column]:
        return [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(self.not_null)],
                *[F.count_if(~F.coalesce(F.expr(w), F.lit(False))).alias(f"not_{i}") for i, w in enumerate(self.where)]]

    def failures(self, seen: Mapping[str, int]) -> list[str]:
        out = []
        if self.least is not None and seen["rows"] < self.least:
            out.append(f"{seen['rows']} rows, fewer than {self.least}")
        if self.most is not None and seen["rows"] > self.most:
            out.append(f"{seen['rows']} rows, more than {self.most}")
        out += [f"{seen[f'null_{i}']} rows without {c}" for i, c in enumerate(self.not_null) if seen[f"null_{i}"]]
        return out + [f"{seen[f'not_{i}']} rows without: {w}" for i, w in enumerate(self.where) if seen[f"not_{i}"]]


def publish(df: DataFrame, name: str, partition_by: Sequence[str] = (), checks: Iterable[Callable[[DataFrame], bool]] = (),
            expect: Expect | None = None) -> DataFrame:
    """Replace the table `name` by these rows, once they are written and all checks hold.

    The rows are written to a table of their own; what `expect` asks is counted
    in that pass, `checks` (as of unique keys) read what was written.  Then the
    view `name` is put on it.  The generation before stays until the next
    refresh, for readers that have begun; older ones are dropped.  Where a
    check fails, the new rows are dropped and the view stays as it was.
    """
    spark = df.sparkSession
    current = _generation(spark, name)
    written = f"{name}__{uuid.uuid4().hex[:12]}"
    seen = Observation()
    observed = df if expect is None else df.observe(seen, *expect.metrics())
    observed.write.partitionBy(*partition_by).saveAsTable(written)
    failed = [] if expect is None else expect.failures(seen.get)
    failed += [f"check {getattr(c, '__name__', c)}" for c in checks if not failed and not c(spark.table(written))]
    if failed:
        spark.sql(f"DROP TABLE {written}")
        raise ValueError(f"{'; '.join(failed)}; {name} stays as it was")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {written}")
    database, _, plain = name.rpartition(".")
    like = f"IN {database} " if database else ""
    for r in spark.sql(f"SHOW TABLES {like}LIKE '{plain}__*'").collect():
        table = f"{database}.{r.tableName}" if database else r.tableName
        if not r.isTemporary and table not in (written, current):
            spark.sql(f"DROP TABLE {table}")
    return spark.table(name)


def append(df: DataFrame, name: str) -> DataFrame:
    """Add rows to a published table, in its own partitioning; columns go by name."""
    spark = df.sparkSession
    current = _generation(spark, name)
    if current is None:
        return publish(df, name)
    df.select(*spark.table(current).columns).write.insertInto(current)
    return spark.table(name)


def build_table(spark: SparkSession, name: str, fn: Callable[[], DataFrame], mode: str = "full") -> DataFrame:
    """Rebuild a table from its function (full), or define it as a view for this session (view)."""
    if mode == "full":
        return publish(fn(), name)
    if mode != "view":
        raise ValueError(f"unknown mode {mode}")
    fn().createOrReplaceTempView(name)
    return spark.table(name)


# --- keyed merges ----------------------------------------------------------

@contextmanager
def dynamic_overwrite(spark: SparkSession):
    """An overwriting insert replaces the partitions it writes to and no others."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _literal(value) -> str:
    """A partition value as SQL; Spark casts it to the column's type."""
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


@dataclass(frozen=True)
class KeyedTable:
    """A catalog table that takes batches by key.

    Partitioned by `_route`, a hash of the key in `routes` values, and then by
    `partition_by`.  Every row of a key stands under one route, whatever its
    other partition values, so a batch reads and rewrites the routes of its
    keys alone.  Choose `routes` so that one holds a few hundred megabytes.
    """
    name: str
    key: tuple[str, ...]
    routes: int = 64
    partition_by: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.key:
            raise ValueError("a merge needs a key; without one it would empty the table")

    def _routed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(ROUTE, F.pmod(F.xxhash64(*[F.col(k) for k in self.key]), F.lit(self.routes)).cast("int"))

    def create(self, df: DataFrame) -> DataFrame:
        """Make the table from these rows; an error where it exists."""
        self._routed(df).repartition(ROUTE, *self.partition_by).write.partitionBy(ROUTE, *self.partition_by).saveAsTable(self.name)
        return self.read(df.sparkSession)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name).drop(ROUTE)

    def merge(self, updates: DataFrame) -> DataFrame:
        """Target rows whose key is not in the batch, and all rows of the batch.

        Staged duplicates stay; a null in the key matches nothing, so such rows
        are added.  With a key that is not unique, as a day, this replaces all
        rows of the days that occur.  A batch that is run again gives the same
        table, also after a failure half-way: partitions are replaced first,
        and only then those dropped that the batch has emptied.
        """
        spark = updates.sparkSession
        table = spark.table(self.name)
        batch = self._routed(updates).select(*table.columns)
        routes = [r[0] for r in batch.select(ROUTE).distinct().collect()]  # `routes` numbers at most
        if not routes:
            return self.read(spark)
        keys = batch.select(ROUTE, *self.key).distinct()
        old = table.filter(F.col(ROUTE).isin(routes))
        stay = old.join(keys, [ROUTE, *self.key], "left_anti").select(*table.columns)
        gone = self._emptied(old, stay, batch) if self.partition_by else []
        rows = stay.unionByName(batch).repartition(ROUTE, *self.partition_by)
        with dynamic_overwrite(spark):
            rows.write.insertInto(self.name, overwrite=True)
        for spec in gone:
            spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({spec})")
        return self.read(spark)

    def _emptied(self, old: DataFrame, stay: DataFrame, batch: DataFrame) -> list[str]:
        """Partitions of the batch's routes that no row is left in; only key and partition columns are read."""
        columns = [ROUTE, *self.partition_by]
        left = stay.select(*columns).unionByName(batch.select(*columns)).distinct()
        same = F.lit(True)
        for c in columns:
            same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
        gone = old.select(*columns).distinct().alias("o").join(left.alias("n"), same, "left_anti")
        return [", ".join(f"`{c}` = {_literal(r[c])}" for c in columns) for r in gone.collect()]
