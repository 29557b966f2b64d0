"""Physical layout: partitions, reuse, statistics, sizes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.functions.units import format_bytes

# Bytes of one value of each fixed-width type.
WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.LongType: 8,
    T.FloatType: 4,
    T.DoubleType: 8,
    T.DateType: 4,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def repartition_n(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Exactly ``n`` partitions, by a shuffle; round robin unless keys are given."""
    return df.repartition(n, *keys)


def coalesce_n(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` partitions, without a shuffle; never more than there are."""
    return df.coalesce(n)


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows of every partition, the empty ones included.

    A task counts the rows it is given; of the rows themselves nothing is read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows = TaskContext.get().partitionId(), sum(map(len, batches))
        columns = [pa.array([number], pa.int32()), pa.array([rows], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["partition", "rows"])

    return df.select(F.lit(0).alias("one")).mapInArrow(count, "partition INT, rows LONG")


def partition_summary(df: DataFrame) -> DataFrame:
    """One row: partitions, how many are empty, rows, and the largest partition over the mean."""
    profile = partition_profile(df)
    mean = F.sum("rows") / F.count("*")
    return profile.agg(
        F.count("*").alias("n_partitions"),
        F.count_if(F.col("rows") == 0).alias("n_empty"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"),
        F.try_divide(F.max("rows"), mean).alias("largest_over_mean"),
    )


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` while the block runs its actions, then release it.

    Use ``StorageLevel.DISK_ONLY`` for frames larger than the executors' memory.  A lost
    executor only costs the recomputation of its blocks.
    """
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


#: What planning by cost needs: the optimizer itself, join orders, and histograms of equal height.
COST_SETTINGS = {
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.planStats.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    "spark.sql.statistics.histogram.enabled": "true",
}


@contextmanager
def planned_by_cost(spark: SparkSession) -> Iterator[None]:
    """Statistics are collected with histograms, and plans are chosen by them, inside the block.

    Queries are planned when their action runs, so run it inside.  The session's own settings
    come back at the end.
    """
    before = {name: spark.conf.get(name, None) for name in COST_SETTINGS}
    for name, value in COST_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def analyze_columns(df: DataFrame, table: str, columns: Sequence[str] = ()) -> DataFrame:
    """Collect row count and column statistics for a registered table and return its frame.

    Inside ``planned_by_cost`` numbers and dates get histograms, and joins of analyzed tables are
    ordered by the rows that filters on these columns leave.
    """
    spark = df.sparkSession
    names = ", ".join(f"`{c}`" for c in columns)
    spark.sql(
        f"ANALYZE TABLE {table} COMPUTE STATISTICS" + (f" FOR COLUMNS {names}" if names else "")
    )
    return spark.table(table)


@contextmanager
def cached_table(df: DataFrame, name: str, level: str = "MEMORY_AND_DISK") -> Iterator[DataFrame]:
    """``df`` as the cached table ``name`` while the block runs: read once, however often it is named.

    Unlike ``reused`` it is filled at once, so that its size is known when joins with it are planned.
    """
    spark = df.sparkSession
    df.createOrReplaceTempView(name)
    try:
        spark.sql(f"CACHE TABLE {name} OPTIONS ('storageLevel' '{level}')")
        yield spark.table(name)
    finally:
        spark.sql(f"UNCACHE TABLE IF EXISTS {name}")
        spark.catalog.dropTempView(name)


def value_bytes(field: T.StructField) -> Column:
    """Data bytes of one value: text by its length, nested values by their JSON text."""
    value = F.col(f"`{field.name}`")
    kind = type(field.dataType)
    if kind in (T.StringType, T.BinaryType):
        size = F.octet_length(value)
    elif kind is T.ArrayType and type(field.dataType.elementType) in WIDTHS:
        size = F.size(value) * WIDTHS[type(field.dataType.elementType)]
    elif kind in (T.ArrayType, T.MapType, T.StructType):
        size = F.octet_length(F.to_json(value))
    else:
        size = F.lit(WIDTHS.get(kind, 16))
    return F.when(value.isNotNull(), size.cast("long")).otherwise(F.lit(0))


def estimate_size(df: DataFrame) -> DataFrame:
    """Data bytes per column and in total, as (column_name, bytes) rows from one pass."""
    fields = df.schema.fields
    one_row = df.agg(
        *[
            F.coalesce(F.sum(value_bytes(f)), F.lit(0)).alias(f"__{i}")
            for i, f in enumerate(fields)
        ]
    )
    sizes = [F.col(f"__{i}") for i in range(len(fields))]
    named = [*zip([f.name for f in fields], sizes, strict=True), ("total", sum(sizes, F.lit(0)))]
    rows = [F.struct(F.lit(n).alias("column_name"), size.alias("bytes")) for n, size in named]
    return one_row.select(F.inline(F.array(*rows)))


def size_report(df: DataFrame) -> DataFrame:
    """``estimate_size`` with the bytes also as text."""
    return estimate_size(df).withColumn("size_text", format_bytes("bytes"))


def total_bytes(df: DataFrame) -> int:
    """The total of ``estimate_size``, measured now (one aggregate, one row to the driver)."""
    row = df.agg(*[F.sum(value_bytes(f)) for f in df.schema.fields]).first()
    return sum(value or 0 for value in row)


def build_bytes(df: DataFrame) -> int:
    """What ``df`` takes as the hashed side of a join, measured now by one aggregate.

    A row there is its key and itself in the row format: eight bytes for each field and 64 fields'
    NULL bits, text and nested values beyond that in steps of eight, with 32 bytes of pointers and
    map slots.  The key repeats at most the whole row, so twice the row is the bound.
    """
    fields = df.schema.fields
    fixed = 8 * (len(fields) + -(-len(fields) // 64))
    moving = [f for f in fields if type(f.dataType) not in WIDTHS]
    beyond = [F.ceil(value_bytes(f) / F.lit(8)) * 8 for f in moving]
    row = F.lit(2 * fixed + 32).cast("long")
    for size in beyond:
        row = row + 2 * size
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


UNITS = {"B": 1, "KiB": 1 << 10, "MiB": 1 << 20, "GiB": 1 << 30, "TiB": 1 << 40, "PiB": 1 << 50, "EiB": 1 << 60}


def plan_bytes(df: DataFrame) -> int:
    """The size that the optimizer expects of ``df``, from its statistics; nothing is run.

    Read from the text of ``EXPLAIN COST``, so it has the text's three digits.
    """
    spark, name = df.sparkSession, f"plan_size_{uuid.uuid4().hex}"
    df.createTempView(name)
    try:
        text = spark.sql(f"EXPLAIN COST SELECT * FROM {name}").first()[0]
    finally:
        spark.catalog.dropTempView(name)
    number, unit = re.search(r"Statistics\(sizeInBytes=([0-9.E+-]+) (\w+)", text).groups()
    return int(float(number) * UNITS[unit])


def size_kinds(df: DataFrame) -> DataFrame:
    """Three sizes of one frame: its data, the optimizer's estimate, and as the hashed side of a join."""
    sizes = (("data", total_bytes(df)), ("plan", plan_bytes(df)), ("build", build_bytes(df)))
    rows = [F.struct(F.lit(k).alias("kind"), F.lit(n).cast("long").alias("bytes")) for k, n in sizes]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))
