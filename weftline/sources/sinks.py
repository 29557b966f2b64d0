"""File and table writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.sources.files import TEXT_TIMES, Schema, scan_json

MB = 1024 * 1024

WRITE_FORMATS = ("parquet", "json", "csv", "orc", "delta", "iceberg")


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Overwrite Parquet in one folder per value of ``columns``.

    The rebalance hint gathers each value into few files and lets AQE cut an oversized value
    into several tasks, so one value holding most rows neither stalls nor makes a file per task.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in columns])
        .write.mode("overwrite")
        .partitionBy(*columns)
        .parquet(path)
    )


def write_data(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite ``path`` in a known format; delta and iceberg need their package on the cluster."""
    if fmt not in WRITE_FORMATS:
        raise ValueError(f"cannot write format {fmt!r}; known: {', '.join(WRITE_FORMATS)}")
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if fmt in ("csv", "json"):
        writer = writer.options(**TEXT_TIMES)
    writer.save(path)


def write_json_sorted(
    df: DataFrame, path: str, keys: Sequence[str], single_file: bool = False
) -> None:
    """A sorted JSON report: range-sorted files whose names follow the order.

    ``single_file`` asks for one file instead, which one task writes; it is for reports that the
    caller knows to be small, such as one row a group.
    """
    # A shuffle into one partition, where coalesce would pull the work before it along.
    ordered = df.repartition(1).sortWithinPartitions(*keys) if single_file else df.orderBy(*keys)
    ordered.write.mode("overwrite").options(**TEXT_TIMES).json(path)


def write_csv_maps(df: DataFrame, path: str) -> None:
    """CSV with a header; map, array and struct columns are stored as JSON text."""
    nested = (T.MapType, T.ArrayType, T.StructType)
    columns = [
        F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema.fields
    ]
    # JSON is full of double quotes: escape them by doubling, as readers of CSV expect.
    (
        df.select(*columns)
        .write.mode("overwrite")
        .options(header=True, escape='"', **TEXT_TIMES)
        .csv(path)
    )


def folder_bytes(spark: SparkSession, path: str, glob: str = "*") -> int:
    """Bytes of the files below ``path``, from the listing alone (no content is read)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def json_to_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    schema: Schema | None = None,
    size_mb: float | None = None,
    split_mb: int = 128,
) -> int:
    """Convert JSON files to about ``size / split_mb`` Parquet files; returns that number.

    The size is taken from the file listing when it is not given.
    """
    if size_mb is None:
        size_mb = folder_bytes(spark, source, "*.json") / MB
    parts = max(1, round(size_mb / split_mb))
    write_parquet(scan_json(spark, source, schema).repartition(parts), target)
    return parts
