import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from presslake import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="presslake-test-"))
        .getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    yield configure(made)
    made.stop()


@pytest.fixture
def shuffled_joins(spark):
    """Joins as on large tables: no side is small enough to broadcast."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    yield spark
    for key in keys:
        spark.conf.unset(key)


def rows(df, *columns):
    """All rows as tuples, in order of their text."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
