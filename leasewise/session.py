"""Session settings and the shared folder for cut lineages."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# SQL settings that the operators count on; all can be changed at run time.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One key may hold a third of a table: let joins split its partition even
    # when that costs one more exchange further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Partial top-k before the shuffle keeps "first row per key" small.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators count on to an existing session."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def check_tuned(spark: SparkSession) -> None:
    """Raise where the session lacks a setting the operators count on; `tune` applies them."""
    wrong = {k: spark.conf.get(k, None) for k, v in RUNTIME.items() if spark.conf.get(k, None) != v}
    if wrong:
        raise ValueError(f"call leasewise.session.tune first; settings that differ: {wrong}")


_asked = threading.Lock()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.

    Only where that is unset and the master is local, as in a quick try, a
    temporary folder takes its place; on a cluster it has to be set.
    """
    context = spark.sparkContext
    with _asked:
        folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="leasewise-checkpoint-")
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
    return folder


def release(spark: SparkSession) -> None:
    """Delete what `cut` and `cut_bucketed` have written in this application; call it once their results are stored."""
    for r in spark.sql("SHOW TABLES LIKE 'cut_*'").collect():
        if not r.isTemporary:
            spark.sql(f"DROP TABLE {r.tableName}")
    _delete(spark, _cuts(spark))


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _cuts(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/cuts-{spark.sparkContext.applicationId}"


def cut(df):
    """Write `df` to the checkpoint folder and go on from the written table.

    Parquet rather than `checkpoint()`: later steps read only the columns
    they use, and the planner knows the table's size.
    """
    spark = df.sparkSession
    path = f"{_cuts(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_PASSING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_shuffles(spark: SparkSession):
    """Shuffle files of the writes begun inside go when the write ends, not when the driver collects its garbage."""
    before = spark.conf.get(_PASSING, None)
    spark.conf.set(_PASSING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PASSING)
        else:
            spark.conf.set(_PASSING, before)


def cut_lean(df):
    """`cut` for models that stay on disk while others are built: no shuffle file outlives the write, and columns are packed with zstd."""
    return _cut_lean(df)[0]


def _cut_lean(df):
    spark = df.sparkSession
    path = f"{_cuts(spark)}/{uuid.uuid4().hex}"
    with passing_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


_open_steps: ContextVar[list | None] = ContextVar("open_steps", default=None)


@contextmanager
def steps():
    """What `cut_step` writes inside is deleted at the end; what is made of it must be written by then."""
    made: list[Callable[[], None]] = []
    token = _open_steps.set(made)
    try:
        yield
    finally:
        _open_steps.reset(token)
        for forget in made:
            forget()


def cut_step(df, forget: Callable[[], None] = lambda: None):
    """`cut_lean` for a step on the way to one table; outside of `steps` it stays until `release`.

    forget: called when the step is deleted.
    """
    out, path = _cut_lean(df)
    if (made := _open_steps.get()) is not None:
        made += [forget, lambda: _delete(df.sparkSession, path)]
    return out


def cut_bucketed(df, by: str, buckets: int | None = None, **options):
    """`cut` into a table bucketed by a column, so that joins and sums by it leave the rows where they are.

    Two tables cut with the same number of buckets (spark.sql.shuffle.partitions
    by default) meet on the column without an exchange.
    """
    spark = df.sparkSession
    name = f"cut_{uuid.uuid4().hex}"
    buckets = buckets or min(int(spark.conf.get("spark.sql.shuffle.partitions")), 100_000)  # Spark's limit of buckets
    df.write.bucketBy(buckets, by).option("path", f"{_cuts(spark)}/{name}").options(**options).format("parquet").saveAsTable(name)
    return spark.table(name)
