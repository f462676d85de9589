import os
import sys
import tempfile

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from leasewise.session import tune
    session = (
        SparkSession.builder.master("local[8]").appName("leasewise-tests").config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="leasewise-checkpoint-")).config("spark.log.level", "ERROR").getOrCreate())
    yield tune(session)
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows to a DataFrame with the given schema text."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    return make


def rows(df, *cols):
    """Sorted tuples of the given columns, for comparing."""
    got = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(got, key=str)
