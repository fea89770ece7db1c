import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark):
    import entityframe as ef

    return ef.EntityStore(spark, tempfile.mkdtemp(prefix="entities-"), buckets=3)


@pytest.fixture(scope="session")
def frame(spark):
    """Small frame from rows and a DDL schema."""

    def make(rows, ddl):
        return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], ddl)

    return make
