"""Queries: projections, filters, code mapping and UDFs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import codes, text
from weftline.operators import columns
from weftline.operators.aggregates import calculate_aggregate
from weftline.operators.joins import join_data
from weftline.plans import jobs, roles
from weftline.plans.registry import query, table
from weftline.sources import files, sinks
from weftline.workspace import workspace


@query("project_columns", roles.RIDE_SQL)
def _project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = jobs.ride_report(roles.trips(spark, sf_dir), roles.zones(spark, sf_dir))
    return roles.plain_money(rides)


@query(
    "derive_length",
    """SELECT l_orderkey, l_linenumber, p_name, CAST(length(p_name) AS INT) AS name_length
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def _derive_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.join(part, lines.l_partkey == part.p_partkey)
    return columns.derive_length(joined, "p_name", "name_length").select(
        "l_orderkey", "l_linenumber", "p_name", "name_length"
    )


@query(
    "rename_key_for_join",
    """SELECT p_partkey AS id, p_name AS name, business_id, lines
       FROM part JOIN (SELECT l_partkey AS business_id, count(*) AS lines
                       FROM lineitem GROUP BY l_partkey) ON p_partkey = business_id""",
)
def _rename_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    business = roles.business(spark, sf_dir).select("business_id", "name")
    counted = calculate_aggregate(
        roles.reviews(spark, sf_dir), "business_id", "review_id", "count", "lines"
    )
    return join_data(columns.rename_key(business, "business_id", "id"), counted, "id", "business_id")


@query("filter_data", "SELECT * FROM part WHERE p_size >= 10")
def _filter_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.filter_data(table(spark, sf_dir, "part"), "p_size >= 10")


@query(
    "filter_active_businesses",
    """SELECT p_partkey AS business_id, p_name AS name, p_brand AS city, p_size AS stars
       FROM part WHERE p_size >= 1""",
)
def _filter_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.active_businesses(roles.business(spark, sf_dir))


@query(
    "filter_string_as_number",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer
       WHERE c_custkey % 7 <> 0 AND c_acctbal > 5000""",
)
def _filter_text_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every seventh balance becomes text that is no number, as dirty files have it.
    balance = F.when(F.col("c_custkey") % 7 == 0, F.lit("n/a")).otherwise(
        F.col("c_acctbal").cast("string")
    )
    path = workspace(spark, "customer-csv")
    sinks.write_data(
        table(spark, sf_dir, "customer").withColumn("c_acctbal", balance), path, "csv"
    )
    read = files.scan_csv_header(spark, path)
    return columns.filter_number_above(read, "c_acctbal", 5000).select("c_custkey", "c_name")


@query(
    "filter_conjunction",
    """SELECT l_orderkey, l_linenumber, l_shipdate, p_name FROM lineitem
       JOIN part ON l_partkey = p_partkey
       WHERE l_shipdate = TIMESTAMP '1998-03-02' AND p_brand = 'Brand#7'""",
)
def _filter_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    joined = lines.join(part, lines.l_partkey == part.p_partkey)
    both = columns.filter_data(columns.on_date(joined, "l_shipdate", "1998-03-02"), "p_brand = 'Brand#7'")
    return both.select("l_orderkey", "l_linenumber", "l_shipdate", "p_name")


@query("point_lookup", "SELECT * FROM orders WHERE o_orderkey = 519")
def _point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.point_lookup(table(spark, sf_dir, "orders"), "o_orderkey", 519)


@query(
    "time_range_filter",
    """SELECT event_id, ts, value FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-05 12:19:00' AND TIMESTAMP '2024-01-09 13:01:20'""",
)
def _time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return columns.time_range(events, "ts", "2024-01-05 12:19:00", "2024-01-09 13:01:20")


@query(
    "date_equality_filter",
    "SELECT event_id, ts, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-12'",
)
def _date_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return columns.on_date(events, "ts", "2024-01-12")


# The order priorities that have a name; the other two have none.
PRIORITY_NAMES = {"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "Medium"}

PRIORITY_CASE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
    WHEN '3-MEDIUM' THEN 'Medium' ELSE {other} END AS priority"""


@query(
    "map_codes_native",
    f"SELECT o_orderkey, {PRIORITY_CASE.format(other='o_orderpriority')} FROM orders",
)
def _map_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = codes.map_codes("o_orderpriority", PRIORITY_NAMES)
    return table(spark, sf_dir, "orders").select("o_orderkey", named.alias("priority"))


UNKNOWN_SQL = PRIORITY_CASE.format(other="'Unknown'")


@query("udf_map_codes", f"SELECT o_orderkey, {UNKNOWN_SQL} FROM orders")
def _udf_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.udf.register("priority_name", codes.udf_map_codes(PRIORITY_NAMES))
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "priority_name(o_orderpriority) AS priority"
    )


@query("pandas_udf_map_codes", f"SELECT o_orderkey, {UNKNOWN_SQL} FROM orders")
def _pandas_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = codes.pandas_udf_map_codes(PRIORITY_NAMES)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", named("o_orderpriority").alias("priority")
    )


@query(
    "pandas_on_spark_head",
    "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey LIMIT 5",
)
def _pandas_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    head = customers.pandas_api(index_col="c_custkey").sort_index().head(5)
    return head.to_spark(index_col="c_custkey")


@query(
    "flag_null_or_blank",
    """SELECT doc_id, source IS NULL OR trim(source) = '' AS is_blank
       FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   '
                            ELSE source END AS source FROM documents)""",
)
def _null_or_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.col("doc_id") % 5
    source = (
        F.when(rest == 0, F.lit(None).cast("string"))
        .when(rest == 1, F.lit(""))
        .when(rest == 2, F.lit("   "))
        .otherwise(F.col("source"))
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", source.alias("source"))
    return documents.select("doc_id", text.is_null_or_blank("source").alias("is_blank"))


@query(
    "struct_expand",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
)
def _struct_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k INT")
    events = table(spark, sf_dir, "events").select("event_id", parsed.alias("data"))
    return columns.expand_struct(events, "data", "event_id")
