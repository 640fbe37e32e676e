import os
import sys
import uuid

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from landed import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("exportkit-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root(spark, tmp_path):
    """A fresh folder per test."""
    return f"{tmp_path}/{uuid.uuid4().hex}"


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{SMALL}/orders.parquet")


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{SMALL}/events.parquet")
