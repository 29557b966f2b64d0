"""Queries: data quality and sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import layout, quality, sketches
from weftline.plans.registry import query, table
from weftline.workspace import materialize

ORDER_COLUMNS = (
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
)


@query(
    "missing_values",
    """SELECT count(*) FILTER (o_orderkey IS NULL) AS o_orderkey,
              count(*) FILTER (o_custkey % 7 = 0) AS o_custkey,
              count(*) FILTER (o_orderstatus = 'P') AS o_orderstatus,
              count(*) FILTER (o_custkey % 5 = 0) AS o_totalprice,
              count(*) FILTER (o_orderdate IS NULL) AS o_orderdate,
              count(*) FILTER (o_orderpriority = '5-LOW') AS o_orderpriority
       FROM orders""",
)
def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_custkey")
    holes = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 7 != 0, key).alias("o_custkey"),
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.when(key % 5 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias(
            "o_totalprice"
        ),
        "o_orderdate",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )
    return quality.missing_values(holes)


@query(
    "duplicate_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def _duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") / 10).alias("stars")
    )


@query(
    "invalid_step_rating",
    """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_quantity / 10 AS stars FROM lineitem)
       WHERE stars < 0.5 OR stars > 5.0 OR stars % 0.5 <> 0""",
)
def _invalid_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.invalid_step(_ratings(spark, sf_dir), "stars")


@query(
    "invalid_range",
    """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_quantity / 10 AS stars FROM lineitem)
       WHERE stars < 1 OR stars > 5""",
)
def _invalid_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.invalid_range(_ratings(spark, sf_dir), "stars", 1, 5)


@query(
    "invalid_range_user",
    """SELECT c_custkey, c_acctbal / 1000 AS average_stars FROM customer
       WHERE c_acctbal / 1000 < 0 OR c_acctbal / 1000 > 5""",
)
def _invalid_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_acctbal") / 1000).alias("average_stars")
    )
    return quality.invalid_range(users, "average_stars", 0, 5)


SIZES = tuple(range(1, 41))


@query(
    "run_checks",
    f"""WITH holes AS (SELECT p_partkey, p_name, nullif(p_size, 13) AS p_size, p_retailprice
                       FROM part),
             rows AS (
        SELECT 'isComplete(p_partkey)' AS "constraint", avg(CAST(p_partkey IS NOT NULL AS INT)) AS ratio
        FROM holes
        UNION ALL SELECT 'isComplete(p_size)', avg(CAST(p_size IS NOT NULL AS INT)) FROM holes
        UNION ALL SELECT 'isUnique(p_partkey)', CAST(sum(CAST(n = 1 AS INT)) AS DOUBLE) / sum(n)
        FROM (SELECT count(*) AS n FROM holes GROUP BY p_partkey)
        UNION ALL SELECT 'isUnique(p_name)', CAST(sum(CAST(n = 1 AS INT)) AS DOUBLE) / sum(n)
        FROM (SELECT count(*) AS n FROM holes GROUP BY p_name)
        UNION ALL SELECT 'isContainedIn(p_size)',
               avg(CAST(p_size IS NULL OR p_size IN ({", ".join(map(str, SIZES))}) AS INT)) FROM holes
        UNION ALL SELECT 'isNonNegative(p_retailprice)', avg(CAST(p_retailprice >= 0 AS INT)) FROM holes)
        SELECT "constraint", ratio, CASE WHEN ratio = 1 THEN 'Success' ELSE 'Failure' END AS status
        FROM rows""",
)
def _checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    holes = part.withColumn("p_size", F.nullif("p_size", F.lit(13)))
    return quality.run_checks(
        holes,
        [
            quality.is_complete("p_partkey"),
            quality.is_complete("p_size"),
            quality.is_unique("p_partkey"),
            quality.is_unique("p_name"),
            quality.is_contained_in("p_size", SIZES),
            quality.is_non_negative("p_retailprice"),
        ],
    )


def _analyzed(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    holes = part.withColumn("p_size", F.nullif("p_size", F.lit(13)))
    return quality.run_analyzers(holes, complete="p_size", distinct="p_partkey", mean="p_size")


@query(
    "run_analyzers",
    """WITH holes AS (SELECT nullif(p_size, 13) AS p_size FROM part)
       SELECT 'Size' AS metric, '*' AS column_name, CAST(count(*) AS DOUBLE) AS value FROM holes
       UNION ALL SELECT 'Completeness', 'p_size', CAST(count(p_size) AS DOUBLE) / count(*) FROM holes
       UNION ALL SELECT 'ApproxCountDistinct', 'p_partkey', CAST(count(DISTINCT p_partkey) AS DOUBLE)
                 FROM part
       UNION ALL SELECT 'Mean', 'p_size', avg(p_size) FROM holes""",
)
def _analyzers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An estimate within three standard deviations is shown as the exact count it estimates."""
    exact = table(spark, sf_dir, "part").select("p_partkey").distinct().agg(F.count("*").cast("double"))
    exact = exact.scalar()
    near = F.abs(F.col("value") - exact) <= exact * 3 * quality.RSD
    is_estimate = F.col("metric") == "ApproxCountDistinct"
    return _analyzed(spark, sf_dir).withColumn(
        "value", F.when(is_estimate & near, exact).otherwise(F.col("value"))
    )


@query(
    "run_analyzers_exact",
    """WITH holes AS (SELECT nullif(p_size, 13) AS p_size FROM part)
       SELECT 'Size' AS metric, '*' AS column_name, CAST(count(*) AS DOUBLE) AS value FROM holes
       UNION ALL SELECT 'Completeness', 'p_size', CAST(count(p_size) AS DOUBLE) / count(*) FROM holes
       UNION ALL SELECT 'Mean', 'p_size', avg(p_size) FROM holes""",
)
def _analyzers_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analyzed(spark, sf_dir).filter(F.col("metric") != "ApproxCountDistinct")


def _profile_row(column: str, kind: str, numeric: bool) -> str:
    numbers = (
        f"round(avg({column}), 6), CAST(min({column}) AS DOUBLE), CAST(max({column}) AS DOUBLE)"
        if numeric
        else "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)"
    )
    return f"""SELECT '{column}' AS column_name, '{kind}' AS data_type,
        CAST(count({column}) AS DOUBLE) / count(*) AS completeness,
        count(DISTINCT {column}) AS distinct_values, {numbers}, count(*) AS n_rows FROM holes"""


PROFILE_SQL = """
    WITH holes AS (SELECT c_custkey, c_name, nullif(c_nationkey, 3) AS c_nationkey, c_acctbal,
                          c_mktsegment FROM customer),
    profile(column_name, data_type, completeness, distinct_values, mean, min_value, max_value,
            n_rows) AS (
""" + " UNION ALL ".join(
    [
        _profile_row("c_custkey", "bigint", True),
        _profile_row("c_name", "string", False),
        _profile_row("c_nationkey", "int", True),
        _profile_row("c_acctbal", "double", True),
        _profile_row("c_mktsegment", "string", False),
    ]
) + ")"


def _customers_with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.withColumn("c_nationkey", F.nullif("c_nationkey", F.lit(3)))


@query("column_profile", PROFILE_SQL + " SELECT * EXCLUDE (n_rows) FROM profile")
def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = quality.column_profile(_customers_with_holes(spark, sf_dir), exact=True)
    return profile.withColumn("mean", F.round("mean", 6))


@query(
    "column_profile_approx",
    PROFILE_SQL
    + """ SELECT column_name, data_type, completeness, true AS estimate_is_near, mean, min_value,
                 max_value FROM profile""",
)
def _profile_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _customers_with_holes(spark, sf_dir)
    exact = quality.column_profile(customers, exact=True).select(
        "column_name", F.col("distinct_values").alias("exact")
    )
    error = F.abs(F.col("distinct_values") - F.col("exact"))
    return (
        quality.column_profile(customers)
        .join(exact, "column_name")
        .withColumn("estimate_is_near", error <= F.col("exact") * 3 * quality.RSD)
        .withColumn("mean", F.round("mean", 6))
        .drop("distinct_values", "exact")
    )


@query(
    "suggest_constraints",
    PROFILE_SQL
    + """
    SELECT column_name, 'complete' AS suggestion FROM profile WHERE completeness = 1
    UNION ALL SELECT column_name, 'unique' FROM profile
              WHERE completeness = 1 AND distinct_values = n_rows
    UNION ALL SELECT column_name, 'non_negative' FROM profile WHERE min_value >= 0
    UNION ALL SELECT column_name, 'categorical' FROM profile
              WHERE distinct_values <= 25 AND distinct_values <= n_rows * 0.1""",
)
def _suggest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.suggest_constraints(_customers_with_holes(spark, sf_dir))


SIZE_SQL = """
    WITH sizes AS (
        SELECT 'doc_id' AS column_name, 8 * count(doc_id) AS bytes FROM documents
        UNION ALL SELECT 'text', CAST(sum(strlen(text)) AS BIGINT) FROM documents
        UNION ALL SELECT 'lang', CAST(sum(strlen(lang)) AS BIGINT) FROM documents
        UNION ALL SELECT 'source', CAST(sum(strlen(source)) AS BIGINT) FROM documents
        UNION ALL SELECT 'n_chars', 8 * count(n_chars) FROM documents),
    report AS (SELECT * FROM sizes
               UNION ALL SELECT 'total', CAST(sum(bytes) AS BIGINT) FROM sizes)
"""


@query("estimate_size", SIZE_SQL + "SELECT * FROM report")
def _size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.estimate_size(table(spark, sf_dir, "documents"))


@query(
    "format_bytes",
    SIZE_SQL
    + """SELECT column_name, bytes, CASE WHEN bytes = 0 THEN '0B'
             WHEN bytes >= 1099511627776
                 THEN CAST(round(CAST(bytes AS DOUBLE) / 1099511627776, 2) AS VARCHAR) || ' TB'
             WHEN bytes >= 1073741824
                 THEN CAST(round(CAST(bytes AS DOUBLE) / 1073741824, 2) AS VARCHAR) || ' GB'
             WHEN bytes >= 1048576
                 THEN CAST(round(CAST(bytes AS DOUBLE) / 1048576, 2) AS VARCHAR) || ' MB'
             WHEN bytes >= 1024
                 THEN CAST(round(CAST(bytes AS DOUBLE) / 1024, 2) AS VARCHAR) || ' KB'
             ELSE CAST(CAST(bytes AS DOUBLE) AS VARCHAR) || ' B' END AS size_text FROM report""",
)
def _size_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.size_report(table(spark, sf_dir, "documents"))


STATUS_SQL = "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus"


@query("repartition_n", STATUS_SQL)
def _repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = layout.repartition_n(table(spark, sf_dir, "orders"), 24)
    return spread.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("coalesce_n", STATUS_SQL)
def _coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    fewer = layout.coalesce_n(table(spark, sf_dir, "orders"), 12)
    return fewer.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "partition_profile",
    """SELECT 24 AS n_partitions, 0 AS n_empty, count(*) AS n_rows, true AS is_balanced FROM lineitem
       UNION ALL SELECT 24, 23, count(*), false FROM lineitem""",
)
def _partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows dealt in turn, and all under one key."""
    lines = table(spark, sf_dir, "lineitem")
    dealt = layout.partition_summary(layout.repartition_n(lines, 24))
    one_key = lines.withColumn("same", F.lit(7))
    keyed = layout.partition_summary(layout.repartition_n(one_key, 24, "same"))
    return dealt.union(keyed).select(
        "n_partitions", "n_empty", "n_rows", (F.col("largest_over_mean") < 1.1).alias("is_balanced")
    )


@query(
    "size_kinds",
    """WITH d AS (SELECT sum(8 + strlen(p_name) + strlen(p_brand) + 4)::BIGINT AS data FROM part)
       SELECT kind, CASE WHEN kind = 'data' THEN data END AS data_bytes, true AS is_plausible
       FROM d, (VALUES ('data'), ('plan'), ('build')) k(kind)""",
)
def _size_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data bytes exactly; the build side takes more than the data and less than twelve times it."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("long"), "p_name", "p_brand", F.col("p_size").cast("int")
    )
    sizes = layout.size_kinds(part)
    kind, size = F.col("kind"), F.col("bytes")
    data = {r.kind: r.bytes for r in sizes.collect()}["data"]
    plausible = (kind != "build") | ((size > data) & (size < 12 * data))
    return sizes.select(
        "kind", F.when(kind == "data", size).alias("data_bytes"), (plausible & (size > 0)).alias("is_plausible")
    )


PART_COLUMNS = ("l_quantity", "l_extendedprice", "l_orderkey", "l_returnflag")


@query(
    "profile_from_parts",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, 1.0::DOUBLE AS completeness,
                   {f"min({c})::DOUBLE" if c != "l_returnflag" else "NULL::DOUBLE"} AS min_value,
                   {f"max({c})::DOUBLE" if c != "l_returnflag" else "NULL::DOUBLE"} AS max_value,
                   true AS is_close FROM lineitem"""
        for c in PART_COLUMNS
    ),
)
def _profile_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines profiled by the year they ship in, written, and merged; estimates against exact values."""
    lines = table(spark, sf_dir, "lineitem")
    years = sketches.sketch_parts(lines.select("l_shipdate", *PART_COLUMNS), F.year("l_shipdate"))
    kept = materialize(years, "year-sketches").where(F.col("column_name") != "l_shipdate")
    merged = sketches.merge_parts(kept)
    # Counted together, distinct values would repeat every line and give each value a median's buffer.
    middles = lines.agg(
        *[F.median(c).alias(f"m_{c}") for c in PART_COLUMNS[:2]],
        *[F.stddev(c).alias(f"s_{c}") for c in PART_COLUMNS[:2]],
    )
    counts = [quality.distinct_count(lines, c).scalar().alias(f"n_{c}") for c in PART_COLUMNS]
    exact = middles.select("*", *counts)
    close = F.lit(True)
    for c in PART_COLUMNS:
        near = F.abs(F.col("distinct_values") - F.col(f"n_{c}")) <= 4 * sketches.DISTINCT_ERROR * F.col(f"n_{c}") + 1
        if c in PART_COLUMNS[:2]:
            near &= F.abs(F.col("median") - F.col(f"m_{c}")) <= 0.1 * F.col(f"s_{c}")
        close = F.when(F.col("column_name") == c, near).otherwise(close)
    beside = merged.join(F.broadcast(exact.withColumn("__all", F.lit(True))), F.col("__all"), "left")
    return beside.select("column_name", "n_rows", "completeness", "min_value", "max_value", close.alias("is_close"))
