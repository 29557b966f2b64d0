"""Projections and filters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import as_number


def project_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep ``source -> new name`` pairs; sources may be alias-qualified (``z.zone``)."""
    return df.select(*[F.col(source).alias(name) for source, name in names.items()])


def derive_length(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.withColumn(name, F.length(column))


def rename_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """Rename a key so that it survives a join next to the other side's key."""
    return df.withColumnRenamed(key, name)


def filter_data(df: DataFrame, condition: Column | str) -> DataFrame:
    return df.filter(condition)


def filter_at_least(df: DataFrame, column: str, threshold: float) -> DataFrame:
    return df.filter(F.col(column) >= threshold)


def filter_number_above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Compare a text column as a number; rows whose text is no number are left out."""
    return df.filter(as_number(column) > threshold)


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == F.lit(value))


def time_range(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows from ``start`` to ``end``, both ends included.

    The bounds are cast to the column's type, so the column itself stays bare and the
    range reaches the scan.
    """
    kind = df.schema[column].dataType
    return df.filter(F.col(column).between(F.lit(start).cast(kind), F.lit(end).cast(kind)))


def on_date(df: DataFrame, column: str, day: str) -> DataFrame:
    """Rows whose date is ``day``, written as a half-open range so that it can be pushed down.

    ``to_date(column) = day`` selects the same rows but hides the column from the scan.
    """
    kind = df.schema[column].dataType
    start = F.to_date(F.lit(day))
    return df.filter(
        (F.col(column) >= start.cast(kind)) & (F.col(column) < F.date_add(start, 1).cast(kind))
    )


def expand_struct(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """The fields of a struct as top-level columns, next to the columns in ``keep``."""
    return df.select(f"{column}.*", *keep)
