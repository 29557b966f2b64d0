"""Queries: aggregations, sorts, previews and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import aggregates, columns, ordering
from weftline.plans import jobs, roles
from weftline.plans.registry import money, query, table
from weftline.sources import sinks
from weftline.sources.files import scan_parquet
from weftline.sources.generate import gen_skew
from weftline.workspace import workspace


@query(
    "agg_global_avg",
    """SELECT round(avg(value), 6) AS avg_value FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-05 12:19:00' AND TIMESTAMP '2024-01-19 13:01:20'""",
)
def _global_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = columns.time_range(
        table(spark, sf_dir, "events"), "ts", "2024-01-05 12:19:00", "2024-01-19 13:01:20"
    )
    return aggregates.agg_named(inside, [], {"avg_value": F.round(F.avg("value"), 6)})


@query("agg_count_rows", "SELECT count(*) AS n FROM lineitem")
def _count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_rows(table(spark, sf_dir, "lineitem"))


@query(
    "calculate_average_rating",
    "SELECT l_partkey AS business_id, avg(l_quantity) AS avg_rating FROM lineitem GROUP BY l_partkey",
)
def _average_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.average_ratings(roles.reviews(spark, sf_dir))


def _aggregate(function: str):
    sql = f"""SELECT l_partkey, {function}(l_quantity) AS result FROM lineitem GROUP BY l_partkey"""

    @query(f"calculate_aggregate_{function}", sql)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = table(spark, sf_dir, "lineitem")
        return aggregates.calculate_aggregate(lines, "l_partkey", "l_quantity", function, "result")


for _function in aggregates.FUNCTIONS:
    _aggregate(_function)


@query(
    "agg_count_column",
    """SELECT nullif(user_id % 7, 0) AS user_group, count(nullif(user_id % 5, 0)) AS n
       FROM events GROUP BY ALL""",
)
def _count_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    events = table(spark, sf_dir, "events").select(
        F.nullif(user % 7, F.lit(0)).alias("user_group"), F.nullif(user % 5, F.lit(0)).alias("who")
    )
    return aggregates.count_column(events, "user_group", "who")


@query(
    "agg_sum_expression",
    f"""WITH rides AS ({roles.RIDE_SQL})
        SELECT hvfhs_license_num,
               CAST(sum(CAST(base_passenger_fare AS DECIMAL(18, 2)) + CAST(tolls AS DECIMAL(18, 2))
                   + CAST(bcf AS DECIMAL(18, 2)) + CAST(sales_tax AS DECIMAL(18, 2))
                   + CAST(congestion_surcharge AS DECIMAL(18, 2))
                   + CAST(tips AS DECIMAL(18, 2))) AS DOUBLE) AS total_fare,
               sum(trip_miles) AS total_trip_miles,
               CAST(sum(trip_time) AS BIGINT) AS total_trip_time
        FROM rides GROUP BY hvfhs_license_num""",
)
def _fare_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = jobs.ride_report(roles.trips(spark, sf_dir), roles.zones(spark, sf_dir))
    return jobs.fare_totals(rides).withColumn("total_fare", F.col("total_fare").cast("double"))


@query(
    "agg_dict_renamed",
    """SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_fare,
              count(o_orderkey) AS ride_count FROM orders GROUP BY o_orderpriority""",
)
def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.agg_named(
        table(spark, sf_dir, "orders"),
        ["o_orderpriority"],
        {
            "total_fare": F.sum(money("o_totalprice")).cast("double"),
            "ride_count": F.count("o_orderkey"),
        },
    )


@query(
    "agg_collect_list",
    """WITH ranked AS (
         SELECT l_orderkey, l_partkey, count(*) OVER (PARTITION BY l_orderkey) AS size,
                (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) - 1) // 4 AS part
         FROM lineitem)
       SELECT l_orderkey, size, CAST(part AS INTEGER) AS part,
              string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS parts
       FROM ranked WHERE size BETWEEN 2 AND 6 GROUP BY l_orderkey, size, part""",
)
def _collect_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = aggregates.collect_values(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey"],
        "l_partkey",
        "parts",
        spread_by=["l_linenumber", "l_suppkey"],
        min_size=2,
        max_size=6,
        part_rows=4,
    )
    text = F.transform("parts", lambda key: key.cast("string"))
    return lists.withColumn("parts", F.array_join(text, ","))


@query("value_counts", "SELECT p_size, count(*) AS n FROM part GROUP BY p_size")
def _value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.value_counts(table(spark, sf_dir, "part"), "p_size")


@query(
    "count_on_date",
    """SELECT CAST(l_shipdate AS DATE) AS ship_day, count(*) AS n FROM lineitem
       WHERE CAST(l_shipdate AS DATE) = DATE '1998-03-02' GROUP BY ALL""",
)
def _count_on_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = columns.on_date(table(spark, sf_dir, "lineitem"), "l_shipdate", "1998-03-02")
    return aggregates.value_counts(
        lines.select(F.to_date("l_shipdate").alias("ship_day")), "ship_day"
    )


DESCRIBED = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(count({c}) AS DOUBLE) AS n,
                   round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
                   min({c}) AS min_value, max({c}) AS max_value FROM lineitem"""
        for c in DESCRIBED
    ),
)
def _describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = aggregates.describe_numeric(table(spark, sf_dir, "lineitem"), DESCRIBED)
    return described.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query(
    "etl_business_rating",
    """SELECT p_partkey AS id, p_name AS name, p_brand AS city, p_size AS stars,
              business_id, avg_rating
       FROM part JOIN (SELECT l_partkey AS business_id, avg(l_quantity) AS avg_rating
                       FROM lineitem GROUP BY l_partkey) ON p_partkey = business_id
       WHERE p_size >= 10""",
)
def business_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship job: filter, average, join, write, and the written result."""
    rated = jobs.business_ratings(
        roles.business(spark, sf_dir), roles.reviews(spark, sf_dir), min_stars=10
    )
    path = workspace(spark, "business-rating")
    sinks.write_data(rated, path, "parquet")
    return scan_parquet(spark, path)


@query("sort_desc", roles.RIDE_SQL + " ORDER BY request_datetime DESC")
def _sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = jobs.ride_report(roles.trips(spark, sf_dir), roles.zones(spark, sf_dir))
    ordered = ordering.sort_desc(
        rides,
        "request_datetime",
        "pickup_datetime",
        "base_passenger_fare",
        "driver_pay",
        write_first=True,
    )
    return roles.plain_money(ordered)


@query(
    "sort_multi_key",
    "SELECT o_custkey, o_orderdate, o_orderkey FROM orders ORDER BY o_custkey, o_orderdate",
)
def _sort_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return ordering.sort_keys(orders, ["o_custkey", "o_orderdate", "o_orderkey"])


@query(
    "sort_multi_key_desc",
    """SELECT l_quantity, l_extendedprice, l_shipdate, l_orderkey, l_linenumber FROM lineitem
       ORDER BY 1 DESC, 2 DESC, 3 DESC, 4 DESC""",
)
def _sort_keys_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_quantity", "l_extendedprice", "l_shipdate", "l_orderkey"]
    lines = table(spark, sf_dir, "lineitem").select(*keys, "l_linenumber")
    return ordering.sort_keys(lines, keys, descending=True)


@query(
    "take_n",
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def _take(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ordering.take_top(orders, 10, [F.desc("o_totalprice"), F.col("o_orderkey")])


@query(
    "union_all_positional",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
       UNION ALL SELECT o_orderkey, DATE '2025-04-20' FROM orders""",
)
def _union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    as_text = orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    today = orders.select("o_orderkey", F.lit("2025-04-20").cast("date").alias("today"))
    both = ordering.union_positional(as_text, today)
    return both.withColumn("day", F.col("day").cast("date"))


@query(
    "skew_generator",
    """SELECT o_orderkey, CASE WHEN copy > 0 THEN 7 ELSE o_custkey END AS o_custkey
       FROM orders, range(6) r(copy)""",
)
def _skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return gen_skew(orders, "o_custkey", 7)
