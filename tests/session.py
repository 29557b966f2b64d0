"""The Spark session of the tests."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def new_session(cores: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("weftline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("WEFTLINE_DRIVER_MEMORY", "8g"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="weftline-tests-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="weftline-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
