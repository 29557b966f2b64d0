"""Ride fraud rules over enriched rides (ride_id, customer_id, driver_id, fare, event_time)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.aggregates import collect_values
from weftline.streaming.windows import tumbling_agg, window_agg

# The rules' limits.
CUSTOMER_RIDES = 5
DRIVER_RIDES = 1

BLOCK = 10_000


def busy_customers(
    rides: DataFrame,
    length: str = "1 minute",
    delay: str | None = "1 minute",
    more_than: int = CUSTOMER_RIDES,
) -> DataFrame:
    """Windows in which a customer has more rides than allowed."""
    counts = tumbling_agg(rides, "customer_id", "fare", "ride_id", length=length, delay=delay)
    return counts.filter(F.col("ride_count") > more_than)


def busy_drivers(
    rides: DataFrame,
    length: str = "1 minute",
    delay: str | None = "1 minute",
    more_than: int = DRIVER_RIDES,
) -> DataFrame:
    """Windows in which a driver has more rides than allowed: the alert, without the list."""
    counts = tumbling_agg(rides, "driver_id", "fare", "ride_id", length=length, delay=delay)
    return counts.filter(F.col("ride_count") > more_than)


def driver_customers(
    rides: DataFrame, length: str = "1 minute", delay: str | None = "1 minute"
) -> DataFrame:
    """Rides per window, driver and customer.

    State holds a count per triple, spread over the cluster by all three, where a list per
    driver would grow in one place.  A window's rows leave together when it closes.
    """
    return window_agg(
        rides,
        F.window("event_time", length),
        ["driver_id", "customer_id"],
        {"rides": F.count("ride_id")},
        delay,
    )


def driver_report(counts: DataFrame, more_than: int = DRIVER_RIDES, **parts) -> DataFrame:
    """Driver windows above the limit with the customers of their rides, one entry per ride.

    Takes the written rows of ``driver_customers``.  Lists come in parts of ``part_rows`` entries
    (see ``collect_values``).
    """
    keys = ["window_start", "window_end", "driver_id"]
    blocks = F.sequence(F.lit(0), F.ceil(F.col("rides") / F.lit(BLOCK)) - 1)
    in_block = F.least(F.lit(BLOCK), F.col("rides") - F.col("block") * BLOCK)
    single = (
        counts.where(F.col("rides") > 0)
        .withColumn("block", F.explode(blocks))
        .withColumn("ride", F.explode(F.sequence(F.lit(1), in_block.cast("int"))))
    )
    return collect_values(
        single,
        keys,
        "customer_id",
        "customer_ids",
        spread_by=["block", "ride"],
        min_size=more_than + 1,
        **parts,
    ).withColumnRenamed("size", "ride_count")
