"""Shared scratch folders for tables an operator has to write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder name below the folder that ``spark.checkpoint.dir`` names.

    Executors on other machines must see what is written there, so a machine-local
    temporary folder is accepted only when the master itself is local.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="weftline-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the workspace and read it back.

    The result has a short lineage that survives lost executors, and its file size gives
    Spark a real statistic to choose the next join by.
    """
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
