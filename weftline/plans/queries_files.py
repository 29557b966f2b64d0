"""Queries: scans, generators, sinks and catalog tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.aggregates import count_column, count_rows
from weftline.operators.layout import total_bytes
from weftline.plans.registry import money, query, table
from weftline.sources import files, generate, sinks, tables
from weftline.workspace import workspace

LINEITEM_SCHEMA = (
    "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber BIGINT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE"
)
PART_SCHEMA = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_size BIGINT"
CUSTOMER_SCHEMA = (
    "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
)

EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"


@query(
    "scan_parquet",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem",
)
def _scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.scan_parquet(spark, f"{sf_dir}/{{lineitem}}.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )


@query(
    "scan_parquet_schema",
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
              l_quantity, l_extendedprice FROM lineitem""",
)
def _scan_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.scan_parquet_schema(spark, f"{sf_dir}/lineitem.parquet", LINEITEM_SCHEMA)


@query(
    "scan_parquet_schema_part",
    "SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size FROM part",
)
def _scan_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.scan_parquet_schema(spark, f"{sf_dir}/part.parquet", PART_SCHEMA)


@query("scan_parquet_schema_customer", "SELECT * FROM customer")
def _scan_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.scan_parquet_schema(spark, f"{sf_dir}/customer.parquet", CUSTOMER_SCHEMA)


def _written(df: DataFrame, fmt: str) -> str:
    path = workspace(df.sparkSession, fmt)
    sinks.write_data(df, path, fmt)
    return path


@query(
    "scan_csv_header",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
              CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal, c_mktsegment
       FROM customer""",
)
def _scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(table(spark, sf_dir, "customer"), "csv")
    return files.scan_csv_header(spark, path).withColumn(
        "c_acctbal", F.col("c_acctbal").try_cast("double")
    )


@query(
    "scan_csv_inferred",
    """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal,
              c_mktsegment FROM customer""",
)
def _scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(table(spark, sf_dir, "customer"), "csv")
    return files.scan_csv_header(spark, path, infer=True).withColumns(
        {c: F.col(c).cast("long") for c in ("c_custkey", "c_nationkey")}
    )


SMALL_FILE_BYTES = 1 << 20


@query("scan_json_small_files", f"SELECT {EVENT_COLUMNS} FROM events")
def _scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    many = max(64, total_bytes(events) // SMALL_FILE_BYTES)  # small files at any size of the table
    path = _written(events.repartition(many), "json")
    return files.scan_json(spark, f"{path}/*.json").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )


def _event_files(spark: SparkSession, sf_dir: str) -> tuple[list[str], DataFrame]:
    """All events as JSON in three folders."""
    events = table(spark, sf_dir, "events")
    root = workspace(spark, "events-json")
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    (
        events.withColumn("part", third)
        .write.partitionBy("part")
        .options(**files.TEXT_TIMES)
        .json(root)
    )
    return [f"{root}/part={i}" for i in range(3)], events


@query("scan_json_file_list", "SELECT user_id, count(event_type) AS n FROM events GROUP BY user_id")
def _scan_json_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, events = _event_files(spark, sf_dir)
    return count_column(
        files.scan_json(spark, paths, events.schema), "user_id", "event_type"
    )


@query(
    "union_files_accumulated",
    "SELECT user_id, count(event_type) AS n FROM events GROUP BY user_id",
)
def _union_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, events = _event_files(spark, sf_dir)
    return count_column(
        files.union_files(spark, paths, events.schema), "user_id", "event_type"
    )


ROUND_TRIP = """
    SELECT 'parquet' AS fmt, * FROM customer
    UNION ALL SELECT 'csv', * FROM customer
    UNION ALL SELECT 'json', * FROM customer
"""


def _round_trip(spark: SparkSession, sf_dir: str, formats: tuple[str, ...]) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    copies = [
        files.read_data(spark, _written(customers, fmt), fmt, customers.schema).select(
            F.lit(fmt).alias("fmt"), *customers.columns
        )
        for fmt in formats
    ]
    return reduce(DataFrame.unionByName, copies)


@query("read_data", ROUND_TRIP)
def _read_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, ("parquet", "csv", "json"))


@query("write_data", ROUND_TRIP + " UNION ALL SELECT 'orc', * FROM customer")
def _write_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, ("parquet", "csv", "json", "orc"))


# A country table of twelve rows.
COUNTRIES = [
    (0, "Argentina"),
    (1, "Bolivia"),
    (2, "Brazil"),
    (3, "Chile"),
    (4, "Colombia"),
    (5, "Ecuador"),
    (6, "Guyana"),
    (7, "Paraguay"),
    (8, "Peru"),
    (9, "Suriname"),
    (10, "Uruguay"),
    (11, "Venezuela"),
]


@query(
    "rows_to_frame",
    f"""SELECT v.id, v.name, n.n_name, count(*) AS customers
        FROM (VALUES {", ".join(f"({i}, '{name}')" for i, name in COUNTRIES)}) v(id, name)
        JOIN nation n ON v.id = n.n_nationkey
        JOIN customer c ON c.c_nationkey = n.n_nationkey
        GROUP BY v.id, v.name, n.n_name""",
)
def _rows_to_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    countries = files.rows_to_frame(spark, COUNTRIES, "id INT, name STRING")
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    per_nation = customer.groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    return (
        countries.join(nation, countries.id == nation.n_nationkey)
        .join(per_nation, F.col("id") == per_nation.c_nationkey)
        .select("id", "name", "n_name", "customers")
    )


def _ids(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return table(spark, sf_dir, name).select(F.col(key).alias("id"))


def _uniform_sql(key: str, name: str) -> str:
    digits = f"substr(md5('42-' || CAST({key} AS VARCHAR) || '-{name}'), 1, 12)"
    return f"(CAST(('0x' || {digits})::BIGINT AS DOUBLE) / 281474976710656.0::DOUBLE)"


@query(
    "gen_transactions",
    "SELECT o_orderkey AS id, o_orderkey % 10 AS country_id, o_orderkey % 100 AS store_id FROM orders",
)
def _gen_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.gen_transactions(_ids(spark, sf_dir, "orders", "o_orderkey")).drop("amount")


@query(
    "gen_transactions_amounts",
    f"""SELECT o_orderkey AS id, o_orderkey % 10 AS country_id, o_orderkey % 100 AS store_id,
               floor({_uniform_sql("o_orderkey", "amount")} * 1000000 + 0.5::DOUBLE) / 100 AS amount
        FROM orders""",
)
def _gen_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.gen_transactions(_ids(spark, sf_dir, "orders", "o_orderkey"))


@query(
    "gen_stores",
    f"""SELECT c_custkey AS id, c_custkey % 10 AS country_id,
               floor({_uniform_sql("c_custkey", "employees")} * 100 + 0.5::DOUBLE) AS employees,
               sha256('store-' || CAST(c_custkey AS VARCHAR)) AS name FROM customer""",
)
def _gen_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.gen_stores(_ids(spark, sf_dir, "customer", "c_custkey"))


@query(
    "gen_iot",
    f"""SELECT {_uniform_sql("event_id", "reading")} AS value,
               strftime(TIMESTAMP '1970-01-01' + to_seconds(1701692381 + event_id),
                        '%Y-%m-%d %H:%M:%S') AS time FROM events""",
)
def _gen_iot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the hashed id, which no other engine computes; tests check it."""
    return generate.gen_iot(_ids(spark, sf_dir, "events", "event_id")).drop("id")


@query(
    "gen_iot_times",
    """SELECT strftime(TIMESTAMP '1970-01-01' + to_seconds(1701692381 + event_id),
                       '%Y-%m-%d %H:%M:%S') AS time FROM events""",
)
def _gen_iot_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.gen_iot(_ids(spark, sf_dir, "events", "event_id")).select("time")


@query("external_table_count", "SELECT count(*) AS n FROM orders")
def _external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    with tables.external_table(spark, f"{sf_dir}/orders.parquet") as name:
        return count_rows(spark.table(name))


@query("sink_parquet", "SELECT * FROM orders")
def _sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "orders")
    sinks.write_parquet(table(spark, sf_dir, "orders"), path)
    return files.scan_parquet(spark, path)


@query("sink_partitioned", "SELECT * FROM orders")
def _sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "orders-by-status")
    sinks.write_partitioned(table(spark, sf_dir, "orders"), path, ["o_orderstatus"])
    return files.scan_parquet(spark, path)


@query(
    "sink_json_single_sorted",
    """SELECT n_name, count(*) AS customers,
              CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS balance
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def _sink_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    report = (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .groupBy("n_name")
        .agg(
            F.count("*").alias("customers"),
            F.sum(money("c_acctbal")).cast("double").alias("balance"),
        )
    )
    path = workspace(spark, "report")
    sinks.write_json_sorted(report, path, ["n_name"], single_file=True)
    return files.scan_json(spark, path, report.schema)


@query(
    "sink_csv_map_as_json",
    """SELECT event_id, '{"type":"' || event_type || '","user":"' || CAST(user_id AS VARCHAR)
              || '"}' AS detail FROM events""",
)
def _sink_csv_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail = F.create_map(
        F.lit("type"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string")
    )
    path = workspace(spark, "events-csv")
    events = table(spark, sf_dir, "events").select("event_id", detail.alias("detail"))
    sinks.write_csv_maps(events, path)
    return spark.read.options(header=True, escape='"').schema(
        "event_id BIGINT, detail STRING"
    ).csv(path)


@query("convert_json_to_parquet", f"SELECT {EVENT_COLUMNS} FROM events")
def _convert_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    source, target = _written(events, "json"), workspace(spark, "events-parquet")
    sinks.json_to_parquet(spark, source, target, events.schema)
    return files.scan_parquet(spark, target)


# Literal rows appended to the indicator table, one of them without a number.
INDICATOR_ROWS = [("manual-1", 10), ("manual-2", None), ("manual-3", 30)]


@query(
    "insert_into_table",
    """SELECT event_type AS id, count(*) AS indicator FROM events GROUP BY event_type
       UNION ALL SELECT * FROM (VALUES ('manual-1', 10), ('manual-2', NULL), ('manual-3', 30))""",
)
def _insert_into(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "indicators")
    name = "weftline_" + path.rsplit("-", 1)[1]
    tables.create_table(spark, name, "id STRING, indicator BIGINT", path)
    try:
        per_type = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
        tables.insert_into_table(per_type, name)
        tables.insert_values(spark, name, INDICATOR_ROWS)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
