"""Queries: joins."""

from __future__ import annotations

import re
from contextlib import ExitStack

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import joins, skew
from weftline.operators.aggregates import agg_named
from weftline.operators.columns import filter_data
from weftline.operators.layout import analyze_columns, cached_table, planned_by_cost, reused
from weftline.plans import jobs, roles
from weftline.plans.registry import money, query, table
from weftline.sources.generate import gen_skew
from weftline.sources.tables import external_table
from weftline.workspace import materialize

REVIEWED_SQL = """
    SELECT l_partkey AS business_id, l_orderkey AS review_id, l_linenumber AS line,
           l_quantity AS stars, p_name AS name, p_brand AS city
    FROM lineitem JOIN part ON l_partkey = p_partkey
"""
REVIEWED = ("business_id", "review_id", "line", "stars", "name", "city")


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    reviews = roles.reviews(spark, sf_dir).drop("date")
    return reviews, roles.business(spark, sf_dir).drop("stars")


@query("join_using", REVIEWED_SQL)
def _using(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.join_using(*_sides(spark, sf_dir), "business_id").select(*REVIEWED)


@query(
    "join_aliased",
    """SELECT l_orderkey AS review_id, l_linenumber AS line, l_quantity AS stars,
              l_partkey AS r_business_id, p_partkey AS b_business_id, p_name AS name
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def _aliased(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = joins.join_aliased(*_sides(spark, sf_dir), "business_id", ("r", "b"))
    return joined.select(
        "r.review_id",
        "r.line",
        "r.stars",
        F.col("r.business_id").alias("r_business_id"),
        F.col("b.business_id").alias("b_business_id"),
        "b.name",
    )


@query("join_broadcast_hash", REVIEWED_SQL)
def _broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.join_broadcast(*_sides(spark, sf_dir), "business_id").select(*REVIEWED)


@query("join_shuffle_hash", REVIEWED_SQL)
def _shuffle_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.join_shuffle_hash(*_sides(spark, sf_dir), "business_id").select(*REVIEWED)


@query("join_sort_merge", REVIEWED_SQL)
def _sort_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.join_sort_merge(*_sides(spark, sf_dir), "business_id").select(*REVIEWED)


# Both sides miss: pending orders lose their customer, building customers get a key of no order.
GAPPED_SQL = """
    SELECT o_orderkey, custkey, c_key, c_name
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS custkey
          FROM orders)
    {how} JOIN (SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN -1 - c_custkey
                            ELSE c_custkey END AS c_key, c_name FROM customer)
    ON custkey = c_key
"""


def _gapped(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("custkey")
    )
    key = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", -1 - key).otherwise(key).alias("c_key"), "c_name"
    )
    return joins.join_data(orders, customers, "custkey", "c_key", how)


@query("join_data_inner", GAPPED_SQL.format(how="INNER"))
def _inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gapped(spark, sf_dir, "inner")


@query("join_data_left", GAPPED_SQL.format(how="LEFT"))
def _left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gapped(spark, sf_dir, "left")


@query("join_data_right", GAPPED_SQL.format(how="RIGHT"))
def _right(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gapped(spark, sf_dir, "right")


@query("join_data_outer", GAPPED_SQL.format(how="FULL OUTER"))
def _outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gapped(spark, sf_dir, "outer")


def _star(spark: SparkSession, sf_dir: str, countries_first: bool) -> DataFrame:
    return jobs.transaction_star(
        roles.transactions(spark, sf_dir),
        roles.stores(spark, sf_dir),
        roles.countries(spark, sf_dir),
        countries_first,
    )


@query("join_left_star", roles.STAR_SQL)
def _left_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir, countries_first=False)


@query("join_left_star_reordered", roles.STAR_SQL)
def _left_star_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir, countries_first=True)


@query("analyze_columns", roles.STAR_SQL)
def _analyzed_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    with (
        external_table(spark, f"{sf_dir}/customer.parquet") as stores,
        external_table(spark, f"{sf_dir}/nation.parquet") as countries,
        planned_by_cost(spark),
    ):
        store_table = analyze_columns(table(spark, sf_dir, "customer"), stores, ["c_custkey"])
        country_table = analyze_columns(table(spark, sf_dir, "nation"), countries, ["n_nationkey"])
        star = jobs.transaction_star(
            roles.transactions(spark, sf_dir),
            store_table.selectExpr("c_custkey AS id", "c_acctbal AS employees", "c_name AS name"),
            country_table.selectExpr("n_nationkey AS id", "n_name AS name"),
        )
        return materialize(star, "analyzed-star")


PRICED_SQL = """
    SELECT p_brand AS brand, n_name AS nation, count(*) AS n
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
    WHERE p_size = 7 GROUP BY p_brand, n_name
"""


@query("analyzed_join_order", PRICED_SQL)
def _analyzed_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same text as the SQL, over analyzed tables: the order of joins is the optimizer's."""
    keys = {
        "lineitem": ["l_partkey", "l_suppkey"],
        "part": ["p_partkey", "p_size"],
        "supplier": ["s_suppkey", "s_nationkey"],
        "nation": ["n_nationkey"],
    }
    with ExitStack() as open_tables, planned_by_cost(spark):
        text = PRICED_SQL
        for name, columns in keys.items():
            registered = open_tables.enter_context(external_table(spark, f"{sf_dir}/{name}.parquet"))
            analyze_columns(table(spark, sf_dir, name), registered, columns)
            text = re.sub(rf"\b{name}\b(?= (ON|JOIN))", registered, text)
        return materialize(spark.sql(text), "analyzed-order")


@query("cached_table", PRICED_SQL)
def _cached_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").where("p_size = 7").select("p_partkey", "p_brand")
    supplier = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    with cached_table(part, "sized_parts") as parts, cached_table(supplier, "placed_suppliers") as suppliers:
        lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
        joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
            suppliers, F.col("l_suppkey") == F.col("s_suppkey")
        )
        counts = joined.groupBy(F.col("p_brand").alias("brand"), F.col("n_name").alias("nation"))
        return materialize(counts.agg(F.count("*").alias("n")), "cached-join")


@query(
    "join_role_playing_dim",
    """SELECT l_orderkey, l_linenumber, np.n_name AS pu_zone, nd.n_name AS do_zone
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation np ON s_nationkey = np.n_nationkey
       JOIN nation nd ON c_nationkey = nd.n_nationkey""",
)
def _roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = roles.shipped_lines(spark, sf_dir).withColumn(
        "pickup", F.col("s_nationkey").cast("string")
    )
    zones = {"pu": F.col("pickup").cast("int"), "do": "c_nationkey"}
    return joins.join_roles(fact, table(spark, sf_dir, "nation"), "n_nationkey", zones).select(
        "l_orderkey",
        "l_linenumber",
        F.col("pu.n_name").alias("pu_zone"),
        F.col("do.n_name").alias("do_zone"),
    )


HOT_CUSTOMER = 7

SKEWED_SQL = f"""
    SELECT o_orderkey, copy, c_custkey, c_name
    FROM (SELECT o_orderkey, copy, o_orderstatus,
                 CASE WHEN copy > 0 THEN {HOT_CUSTOMER} ELSE o_custkey END AS c_custkey
          FROM orders, range(6) r(copy))
    JOIN customer USING (c_custkey)
    WHERE o_orderstatus = 'F' AND c_acctbal > 0
"""


def _skewed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders of which five sixths belong to one customer, and the customers."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_custkey").alias("c_custkey")
    )
    skewed = gen_skew(orders, "c_custkey", HOT_CUSTOMER, copy_column="copy")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return (
        filter_data(skewed, "o_orderstatus = 'F'").withColumn("copy", F.col("copy").cast("long")),
        filter_data(customers, "c_acctbal > 0"),
    )


SKEWED = ("o_orderkey", "copy", "c_custkey", "c_name")


@query("join_skewed", SKEWED_SQL)
def _join_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.join_using(*_skewed(spark, sf_dir), "c_custkey").select(*SKEWED)


@query("join_salted", SKEWED_SQL)
def _join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = _skewed(spark, sf_dir)
    return joins.join_salted(
        orders, customers, "c_custkey", rows_per_salt=10_000, spread_by=["o_orderkey", "copy"]
    ).select(*SKEWED)


@query("join_salted_fixed", SKEWED_SQL)
def _join_salted_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = _skewed(spark, sf_dir)
    return joins.join_salted(
        orders, customers, "c_custkey", salts=16, spread_by=["o_orderkey", "copy"]
    ).select(*SKEWED)


@query(
    "heavy_hitters",
    f"""WITH orders_ AS (SELECT CASE WHEN copy > 0 THEN {HOT_CUSTOMER} WHEN o_orderstatus <> 'P' THEN o_custkey
                                     END AS c_custkey FROM orders, range(6) r(copy))
        SELECT c_custkey, count(*) AS n FROM orders_ GROUP BY c_custkey
        HAVING count(*) >= 0.002 * (SELECT count(*) FROM orders_)""",
)
def _heavy_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with two orders in a thousand; pending orders of the first copy have none."""
    orders = table(spark, sf_dir, "orders")
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    keys = orders.select("o_orderkey", known.alias("c_custkey"))
    return skew.heavy_hitters(gen_skew(keys, "c_custkey", HOT_CUSTOMER, copy_column="copy"), "c_custkey", 0.002)


@query(
    "join_filtered_dim_avg",
    """SELECT p_brand AS city, avg(l_quantity) AS avg_stars, count(*) AS n_reviews
       FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE p_brand = 'Brand#12' GROUP BY p_brand""",
)
def _filtered_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews, business = _sides(spark, sf_dir)
    in_city = joins.join_using(reviews, filter_data(business, "city = 'Brand#12'"), "business_id")
    return agg_named(
        in_city, ["city"], {"avg_stars": F.avg("stars"), "n_reviews": F.count("*")}
    )


REUSE_SQL = """
    SELECT 'brand' AS kind, p_brand AS value, count(*) AS n,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS price
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
    UNION ALL
    SELECT 'type', p_type, count(*),
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE)
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type
"""


def _reuse(spark: SparkSession, sf_dir: str, level) -> DataFrame:
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.join(part, lines.l_partkey == part.p_partkey).select(
        "p_brand", "p_type", money("l_extendedprice").alias("price")
    )
    # Both aggregates run inside the block, so the kept frame can be released at its end.
    with reused(joined, level) as kept:
        reports = [
            kept.groupBy(F.lit(kind).alias("kind"), F.col(column).alias("value")).agg(
                F.count("*").alias("n"), F.sum("price").cast("double").alias("price")
            )
            for kind, column in (("brand", "p_brand"), ("type", "p_type"))
        ]
        return materialize(reports[0].union(reports[1]), "reuse")


@query("reuse_cached", REUSE_SQL)
def _reuse_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reuse(spark, sf_dir, StorageLevel.MEMORY_AND_DISK)


@query("reuse_disk", REUSE_SQL)
def _reuse_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reuse(spark, sf_dir, StorageLevel.DISK_ONLY)
