"""Tables registered in the session catalog."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def external_table(spark: SparkSession, path: str) -> Iterator[str]:
    """Register existing Parquet files as a table for the length of a ``with`` block.

    Dropping an external table leaves its files; frames built inside stay usable.
    """
    name = f"weftline_{uuid.uuid4().hex}"
    spark.catalog.createTable(name, path=path, source="parquet")
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table(spark: SparkSession, name: str, ddl: str, path: str) -> None:
    """An empty Parquet table whose files live at ``path``."""
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION '{path}'")


def insert_into_table(df: DataFrame, name: str) -> None:
    """Append rows by position, as INSERT INTO does."""
    df.write.insertInto(name)


def insert_values(spark: SparkSession, name: str, rows: Sequence[tuple]) -> None:
    """Append literal rows, as INSERT INTO .. VALUES does; None becomes NULL."""
    insert_into_table(spark.createDataFrame(list(rows), spark.table(name).schema), name)
