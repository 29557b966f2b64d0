"""The test tables in the roles of the jobs' inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.plans.registry import money, table


def business(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part: city is the brand, stars the size."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("business_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("city"),
        F.col("p_size").alias("stars"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem: stars is the quantity, date the shipping date."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("review_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("business_id"),
        F.col("l_quantity").alias("stars"),
        F.col("l_shipdate").alias("date"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its order; it runs from the supplier's to the customer's nation."""
    return shipped_lines(spark, sf_dir).select(
        F.col("o_orderpriority").alias("hvfhs_license_num"),
        F.col("s_nationkey").cast("string").alias("PULocationID"),
        F.col("c_nationkey").alias("DOLocationID"),
        F.col("o_orderdate").alias("request_datetime"),
        F.col("l_shipdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("l_quantity").alias("trip_miles"),
        F.col("l_linenumber").cast("long").alias("trip_time"),
        money("l_extendedprice").alias("base_passenger_fare"),
        money("l_tax").alias("tolls"),
        money("l_discount").alias("bcf"),
        money("l_tax").alias("sales_tax"),
        money("l_discount").alias("congestion_surcharge"),
        money("l_tax").alias("tips"),
        money("o_totalprice").alias("driver_pay"),
        F.col("l_returnflag").alias("shared_request_flag"),
        F.col("l_linestatus").alias("shared_match_flag"),
    )


def shipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its supplier, order and customer.

    Orders meet customers before they meet the lines, so the large table is not shuffled
    once more for the customer key.
    """
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    placed = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return lines.join(placed, lines.l_orderkey == placed.o_orderkey).join(
        suppliers, lines.l_suppkey == suppliers.s_suppkey
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation within its region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
    )


RIDE_SQL = """
    SELECT o_orderpriority AS hvfhs_license_num,
           rs.r_name AS "PU_Borough", ns.n_name AS "PU_Zone",
           rc.r_name AS "DO_Borough", nc.n_name AS "DO_Zone",
           o_orderdate AS request_datetime, l_shipdate AS pickup_datetime,
           l_shipdate AS dropoff_datetime, l_quantity AS trip_miles,
           CAST(l_linenumber AS BIGINT) AS trip_time,
           l_extendedprice AS base_passenger_fare, l_tax AS tolls, l_discount AS bcf,
           l_tax AS sales_tax, l_discount AS congestion_surcharge, l_tax AS tips,
           o_totalprice AS driver_pay,
           l_returnflag AS shared_request_flag, l_linestatus AS shared_match_flag
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ns ON s_nationkey = ns.n_nationkey
    JOIN region rs ON ns.n_regionkey = rs.r_regionkey
    JOIN nation nc ON c_nationkey = nc.n_nationkey
    JOIN region rc ON nc.n_regionkey = rc.r_regionkey
"""

MONEY_COLUMNS = (
    "base_passenger_fare",
    "tolls",
    "bcf",
    "sales_tax",
    "congestion_surcharge",
    "tips",
    "driver_pay",
)


def plain_money(rides: DataFrame) -> DataFrame:
    """The amounts of a ride report as doubles, as they are stored."""
    return rides.withColumns({c: F.col(c).cast("double") for c in MONEY_COLUMNS})


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders; store keys are shifted by one and country keys run past the nations, so both miss."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_totalprice").alias("amount"),
        (F.col("o_orderkey") % 30).alias("country_id"),
        (F.col("o_custkey") + 1).alias("store_id"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("employees"),
        F.col("c_name").alias("name"),
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")
    )


STAR_SQL = """
    SELECT o_orderkey AS id, o_totalprice AS amount, n_name AS country_name,
           c_acctbal AS employees, c_name AS store_name
    FROM orders
    LEFT JOIN nation ON o_orderkey % 30 = n_nationkey
    LEFT JOIN customer ON o_custkey + 1 = c_custkey
"""
