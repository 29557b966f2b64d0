"""Synthetic rows computed from an id column.

Each generator takes any frame of ids: ``spark.range`` for made-up data, or the key column
of a table, so the number of rows and tasks follows the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the generated data sets.
COUNTRY_COUNT = 10
STORE_COUNT = 100
MAX_AMOUNT = 10000
MAX_EMPLOYEES = 100
FIRST_READING = 1701692381  # unix seconds

SEED = 42


def id_range(spark: SparkSession, n: int, parts: int | None = None) -> DataFrame:
    return spark.range(0, n, 1, parts)


def _uniform(key: Column, name: str) -> Column:
    """A number in [0, 1) from md5 digits of the row's key, so a retried task repeats it."""
    digits = F.substring(F.md5(F.concat_ws("-", F.lit(str(SEED)), key.cast("string"), F.lit(name))), 1, 12)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 48))


def gen_transactions(ids: DataFrame) -> DataFrame:
    """id, amount (two decimals), country_id and store_id."""
    key = F.col("id")
    return ids.select(
        key,
        (F.floor(_uniform(key, "amount") * (MAX_AMOUNT * 100) + 0.5) / 100).alias("amount"),
        (key % COUNTRY_COUNT).alias("country_id"),
        (key % STORE_COUNT).alias("store_id"),
    )


def gen_stores(ids: DataFrame) -> DataFrame:
    """id, employees, country_id and a unique name."""
    key = F.col("id")
    return ids.select(
        key,
        F.floor(_uniform(key, "employees") * MAX_EMPLOYEES + 0.5).cast("double").alias("employees"),
        (key % COUNTRY_COUNT).alias("country_id"),
        F.sha2(F.concat_ws("-", F.lit("store"), key.cast("string")), 256).alias("name"),
    )


def gen_iot(ids: DataFrame) -> DataFrame:
    """Hashed id, value in [0, 1) and a reading time as ``yyyy-MM-dd HH:mm:ss`` text."""
    key = F.col("id")
    return ids.select(
        F.hash(key).alias("id"),
        _uniform(key, "reading").alias("value"),
        F.from_unixtime(key + FIRST_READING).alias("time"),
    )


def gen_skew(
    df: DataFrame, column: str, value, copies: int = 5, copy_column: str | None = None
) -> DataFrame:
    """The frame plus ``copies`` copies of every row in which ``column`` holds one hot value.

    One scan: each row is repeated in place instead of joining or re-reading the input.
    ``copy_column`` keeps the copy number (0 = original), which tells equal copies apart.
    """
    number = copy_column or "__copy"
    hot = F.lit(value).cast(df.schema[column].dataType)
    repeated = df.withColumn(number, F.explode(F.sequence(F.lit(0), F.lit(copies))))
    stamped = repeated.withColumn(
        column, F.when(F.col(number) > 0, hot).otherwise(F.col(column))
    )
    return stamped if copy_column else stamped.drop(number)
