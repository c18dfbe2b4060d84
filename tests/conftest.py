import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="threadloom-warehouse-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.driver.memory", "8g")
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")  # short jobs
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def set_conf(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def small(spark):
    """Frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
