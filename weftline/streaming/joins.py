"""Joins of event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.joins import join_salted
from weftline.operators.layout import total_bytes
from weftline.operators.skew import BROADCAST_LIMIT_BYTES

TIME = "event_time"


def join_streams(
    events: DataFrame,
    profiles: DataFrame,
    key: str,
    within: str | None = None,
    delays: tuple[str | None, str | None] = ("1 minute", "1 minute"),
    salts: int = 1,
    row_id: str | None = None,
) -> DataFrame:
    """Inner join of two unbounded streams; the key and ``event_time`` come from ``events``.

    ``within`` is how long a profile row stays valid after its own event time.  It sets a
    watermark on both inputs (a delay of None: the input has one already), which lets Spark
    discard join state that can no longer match; without it the state keeps every row ever
    seen.  AQE does not split streaming joins, so
    hot keys are spread here: each event takes one of ``salts`` salts from a hash of
    ``row_id``, each profile is kept once per salt.
    """
    if within is not None:
        events = _watermarked(events, delays[0])
        profiles = _watermarked(profiles, delays[1])
    details = [c for c in profiles.columns if c not in (key, TIME)]
    right = profiles.select(
        F.col(key).alias("__key"),
        F.col(TIME).alias("__since"),
        *details,
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__copy"),
    )
    salt = F.pmod(F.xxhash64(row_id or key), F.lit(salts)).cast("int")
    left = events.withColumn("__salt", salt)
    condition = (F.col(key) == F.col("__key")) & (F.col("__salt") == F.col("__copy"))
    if within is not None:
        until = F.col("__since") + F.expr(f"INTERVAL {within}")
        condition &= (F.col(TIME) >= F.col("__since")) & (F.col(TIME) <= until)
    return left.join(right, condition).drop("__key", "__since", "__copy", "__salt")


def _watermarked(df: DataFrame, delay: str | None) -> DataFrame:
    return df if delay is None else df.withWatermark(TIME, delay)


def join_static(
    events: DataFrame, table: DataFrame, key: str, row_id: str, salts: int = 16
) -> DataFrame:
    """Inner join of a stream with a table, without join state.

    Prefer it for customers and drivers, whose rows change rarely.  A table whose measured size
    is within the limit is broadcast; a larger one is joined with the events' keys spread over
    ``salts``, since AQE does not split the joins of stateful streams.
    """
    if total_bytes(table) <= BROADCAST_LIMIT_BYTES:
        return events.join(F.broadcast(table), key)
    return join_salted(events, table, key, salts=salts, spread_by=[row_id])
