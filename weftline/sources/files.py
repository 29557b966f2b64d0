"""File readers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# JSON and CSV keep milliseconds unless told otherwise; tables here carry microseconds.
TEXT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

READ_FORMATS = ("parquet", "csv", "json", "orc")

Schema = T.StructType | str


def scan_parquet(spark: SparkSession, *globs: str) -> DataFrame:
    """Parquet files by path or glob; the schema comes from the footers."""
    return spark.read.parquet(*globs)


def scan_parquet_schema(spark: SparkSession, path: str, schema: Schema) -> DataFrame:
    """Parquet with a declared schema.

    Declare the stored type (or a wider one) and cast afterwards: a narrower type counts
    well and then fails at the first column that is really read.
    """
    return spark.read.schema(schema).parquet(path)


def scan_csv_header(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    infer: bool = False,
    schema: Schema | None = None,
) -> DataFrame:
    """Delimited text with a header line: all strings, inferred types or a declared schema."""
    reader = spark.read.options(header=True, sep=sep, **TEXT_TIMES)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def scan_json(
    spark: SparkSession, paths: str | Sequence[str], schema: Schema | None = None
) -> DataFrame:
    """JSON lines from one glob or from a list of paths, planned as one scan.

    Small files are packed into shared splits, so a list costs one job whatever its length.
    Without ``schema`` Spark reads every file once more to infer it.
    """
    reader = spark.read.options(**TEXT_TIMES)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(paths if isinstance(paths, str) else list(paths))


def union_files(spark: SparkSession, paths: Iterable[str], schema: Schema) -> DataFrame:
    """One read per file, all of them kept: the union starts from an empty seed.

    Prefer ``scan_json`` with the whole list; this form is for files that need their own
    reader, and its plan grows with the number of files.
    """
    seed = spark.createDataFrame([], schema)
    reads = (scan_json(spark, path, schema) for path in paths)
    return reduce(DataFrame.unionByName, reads, seed)


def read_data(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: Schema | None = None
) -> DataFrame:
    """Read ``path`` in one of the known formats; any other name is an error."""
    if fmt not in READ_FORMATS:
        raise ValueError(f"cannot read format {fmt!r}; known: {', '.join(READ_FORMATS)}")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if fmt in ("csv", "json"):
        reader = reader.options(**TEXT_TIMES)
    return reader.load(path)


def rows_to_frame(
    spark: SparkSession, rows: Iterable[tuple], schema: Schema | Sequence[str]
) -> DataFrame:
    """A frame from literal rows with column names, or with names and types (rows may be empty)."""
    return spark.createDataFrame(list(rows), schema)
