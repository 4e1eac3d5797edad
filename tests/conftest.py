import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(ROOT), *filter(None, [os.environ.get("PYTHONPATH")])]
)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shopgrain-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    saved = {}

    def set_all(**settings):
        for key, value in settings.items():
            name = key.replace("__", ".")
            saved.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_all
    for name, value in saved.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture(scope="session")
def values():
    """The rows of a frame as a list of tuples (of values for one column)."""

    def collect(df, *columns):
        rows = df.select(*columns).collect() if columns else df.collect()
        if len(rows) and len(rows[0]) == 1:
            return [r[0] for r in rows]
        return [tuple(r) for r in rows]

    return collect
