from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def build_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("wordbase-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="wordbase-tests-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return build_session()


@pytest.fixture()
def settings(spark):
    changed = {}

    def set_(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            changed[key] = spark.conf.get(key)
            spark.conf.set(key, value)

    yield set_
    for key, value in changed.items():
        spark.conf.set(key, value)
