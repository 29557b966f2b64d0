"""Windowed aggregates over event time.

Results carry ``window_start`` and ``window_end``.  Counts and sums combine before the
shuffle, so a hot key costs one partial row per task and window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIME = "event_time"


def _bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *columns,
    )


def _late_after(df: DataFrame, delay: str | None) -> DataFrame:
    """Set the watermark, unless the input already has one (``delay`` is None)."""
    return df if delay is None else df.withWatermark(TIME, delay)


def window_agg(
    df: DataFrame,
    window: Column,
    keys: Sequence[str],
    aggregates: Mapping[str, Column],
    delay: str | None,
) -> DataFrame:
    """Aggregates per window and key; rows behind the watermark are dropped."""
    columns = [expression.alias(name) for name, expression in aggregates.items()]
    grouped = _late_after(df, delay).groupBy(window.alias("window"), *keys).agg(*columns)
    return _bounds(grouped, [*keys, *aggregates])


def sliding_count(
    df: DataFrame,
    key: str,
    alias: str = "activity_count",
    length: str = "5 minutes",
    every: str = "2 minutes",
    delay: str | None = "1 minute",
) -> DataFrame:
    return window_agg(df, F.window(TIME, length, every), [key], {alias: F.count("*")}, delay)


def session_count(
    df: DataFrame,
    key: str,
    alias: str = "session_count",
    gap: str = "10 minutes",
    delay: str | None = "5 minutes",
) -> DataFrame:
    """Rows per session: a pause longer than ``gap`` starts a new one.

    With the defaults of ``run.start`` each task merges its rows into sessions before the shuffle.
    """
    return window_agg(df, F.session_window(TIME, gap), [key], {alias: F.count("*")}, delay)


def tumbling_agg(
    df: DataFrame,
    key: str,
    amount: str,
    counted: str,
    names: tuple[str, str] = ("total_fare", "ride_count"),
    length: str = "1 minute",
    delay: str | None = "1 minute",
) -> DataFrame:
    """Sum of ``amount`` and count of ``counted`` per window and key."""
    total, number = names
    aggregates = {total: F.sum(amount), number: F.count(counted)}
    return window_agg(df, F.window(TIME, length), [key], aggregates, delay)
