"""Whole jobs: business ratings, ride reports, transaction star, skewed reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.aggregates import agg_named, calculate_aggregate, sum_of_terms
from weftline.operators.columns import filter_at_least, project_columns, rename_key
from weftline.operators.joins import join_data, join_roles, join_star_left
from weftline.sources.files import read_data
from weftline.sources.sinks import write_data

# Column types of the business review data set.
BUSINESS_SCHEMA = (
    "business_id STRING, name STRING, address STRING, city STRING, state STRING,"
    " postal_code STRING, latitude FLOAT, longitude FLOAT, stars FLOAT, review_count BIGINT,"
    " is_open INT"
)
REVIEW_SCHEMA = (
    "review_id STRING, user_id STRING, business_id STRING, stars INT, date STRING, text STRING,"
    " useful BIGINT, funny BIGINT, cool BIGINT"
)
USER_SCHEMA = (
    "user_id STRING, name STRING, review_count BIGINT, yelping_since STRING, useful BIGINT,"
    " funny BIGINT, cool BIGINT, fans BIGINT, average_stars FLOAT, compliment_hot BIGINT,"
    " compliment_more BIGINT, compliment_profile BIGINT, compliment_cute BIGINT,"
    " compliment_list BIGINT, compliment_note BIGINT, compliment_plain BIGINT,"
    " compliment_cool BIGINT, compliment_funny BIGINT, compliment_writer BIGINT,"
    " compliment_photos BIGINT"
)

# Lowest rating of an active business, and the columns of the ride report.
MIN_STARS = 1
RIDE_COLUMNS = (
    "request_datetime",
    "pickup_datetime",
    "dropoff_datetime",
    "trip_miles",
    "trip_time",
    "base_passenger_fare",
    "tolls",
    "bcf",
    "sales_tax",
    "congestion_surcharge",
    "tips",
    "driver_pay",
    "shared_request_flag",
    "shared_match_flag",
)
FARE_TERMS = ("base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "tips")


def active_businesses(business: DataFrame, min_stars: float = MIN_STARS) -> DataFrame:
    return filter_at_least(business, "stars", min_stars)


def average_ratings(reviews: DataFrame) -> DataFrame:
    return calculate_aggregate(reviews, "business_id", "stars", "avg", "avg_rating")


def business_ratings(
    business: DataFrame, reviews: DataFrame, min_stars: float = MIN_STARS
) -> DataFrame:
    """Active businesses with the average of their reviews.

    Reviews are averaged before the join, so the join sees one row per business.
    """
    active = rename_key(active_businesses(business, min_stars), "business_id", "id")
    return join_data(active, average_ratings(reviews), "id", "business_id")


def run_business_ratings(
    spark: SparkSession,
    business_path: str,
    reviews_path: str,
    output_path: str,
    fmt: str = "parquet",
    keep_inputs: bool = False,
) -> None:
    """Read both inputs, rate, write ``output_path/rated``; optionally the inputs as well."""
    business, reviews = read_data(spark, business_path), read_data(spark, reviews_path)
    write_data(business_ratings(business, reviews), f"{output_path}/rated", fmt)
    if keep_inputs:
        write_data(business, f"{output_path}/business", fmt)
        write_data(reviews, f"{output_path}/reviews", fmt)


def ride_report(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips with the borough and zone names of both ends."""
    rides = join_roles(
        trips,
        zones,
        "LocationID",
        {"zones_pu": F.col("PULocationID").cast("int"), "zones_do": "DOLocationID"},
    )
    ends = {
        "zones_pu.Borough": "PU_Borough",
        "zones_pu.Zone": "PU_Zone",
        "zones_do.Borough": "DO_Borough",
        "zones_do.Zone": "DO_Zone",
    }
    kept = {name: name for name in ("hvfhs_license_num", *RIDE_COLUMNS)}
    return project_columns(rides, kept | ends)


def fare_totals(rides: DataFrame) -> DataFrame:
    """Fare, miles and time per licence."""
    return agg_named(
        rides,
        ["hvfhs_license_num"],
        {
            "total_fare": sum_of_terms(*FARE_TERMS),
            "total_trip_miles": F.sum("trip_miles"),
            "total_trip_time": F.sum("trip_time"),
        },
    )


def transaction_star(
    transactions: DataFrame, stores: DataFrame, countries: DataFrame, countries_first: bool = True
) -> DataFrame:
    """Transactions with the names of their store and country where there is one."""
    t, s, c = transactions.alias("t"), stores.alias("s"), countries.alias("c")
    country = (c, F.col("t.country_id") == F.col("c.id"))
    store = (s, F.col("t.store_id") == F.col("s.id"))
    joined = join_star_left(t, *((country, store) if countries_first else (store, country)))
    return project_columns(
        joined,
        {
            "t.id": "id",
            "t.amount": "amount",
            "c.name": "country_name",
            "s.employees": "employees",
            "s.name": "store_name",
        },
    )
