import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("cargolens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .config("spark.sql.warehouse.dir", f"file://{tmp_path_factory.mktemp('catalog')}")
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def no_broadcast(spark):
    """Every lookup takes the shuffled, salted way."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
