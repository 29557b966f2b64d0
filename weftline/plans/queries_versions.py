"""Queries: versions of a customer table.

v0 written, v1 updated, v2 deleted from, v3 merged insert-only, v4 upserted, v5 = v2 restored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import versions
from weftline.plans.registry import query, table
from weftline.workspace import workspace

KEY = "c_custkey"
COLUMNS = (KEY, "c_name", "c_acctbal", "c_mktsegment")

VERSIONS_SQL = """
    WITH v0 AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer),
    v1 AS (SELECT c_custkey, c_name,
                  CASE WHEN c_mktsegment = 'BUILDING' THEN 32.0 ELSE c_acctbal END AS c_acctbal,
                  CASE WHEN c_mktsegment = 'BUILDING' THEN 'MANAGED' ELSE c_mktsegment END
                      AS c_mktsegment FROM v0),
    v2 AS (SELECT * FROM v1 WHERE NOT c_acctbal <= 30),
    added AS (SELECT s_suppkey AS c_custkey, s_name AS c_name, s_acctbal AS c_acctbal,
                     'ADDED' AS c_mktsegment FROM supplier),
    v3 AS (SELECT * FROM v2
           UNION ALL SELECT * FROM added WHERE c_custkey NOT IN (SELECT c_custkey FROM v2)),
    changed AS (SELECT 3 * s_suppkey AS c_custkey, s_name AS c_name, s_acctbal AS c_acctbal,
                       'CHANGED' AS c_mktsegment FROM supplier),
    v4 AS (SELECT v3.c_custkey, v3.c_name, coalesce(c.c_acctbal, v3.c_acctbal) AS c_acctbal,
                  coalesce(c.c_mktsegment, v3.c_mktsegment) AS c_mktsegment
           FROM v3 LEFT JOIN changed c ON v3.c_custkey = c.c_custkey
           UNION ALL SELECT * FROM changed WHERE c_custkey NOT IN (SELECT c_custkey FROM v3)),
    history AS (SELECT *, 0 AS version FROM v0 UNION ALL SELECT *, 1 FROM v1
                UNION ALL SELECT *, 2 FROM v2 UNION ALL SELECT *, 3 FROM v3
                UNION ALL SELECT *, 4 FROM v4)
"""

def _v0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(*COLUMNS)


def _v1(v0: DataFrame) -> DataFrame:
    building = F.col("c_mktsegment") == "BUILDING"
    return versions.update_where(
        v0, building, {"c_acctbal": F.lit(32.0), "c_mktsegment": F.lit("MANAGED")}
    )


def _v2(v1: DataFrame) -> DataFrame:
    return versions.delete_where(v1, F.col("c_acctbal") <= 30)


def _suppliers(spark: SparkSession, sf_dir: str, key, segment: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        key.alias(KEY),
        F.col("s_name").alias("c_name"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit(segment).alias("c_mktsegment"),
    )


def _v3(spark: SparkSession, sf_dir: str, v2: DataFrame) -> DataFrame:
    added = _suppliers(spark, sf_dir, F.col("s_suppkey"), "ADDED")
    return versions.merge_insert_only(v2, added, KEY)


def _v4(spark: SparkSession, sf_dir: str, v3: DataFrame) -> DataFrame:
    changed = _suppliers(spark, sf_dir, 3 * F.col("s_suppkey"), "CHANGED")
    return versions.merge_upsert(v3, changed, KEY, ["c_acctbal", "c_mktsegment"])


def _table(spark: SparkSession, sf_dir: str, newest: int = 4) -> versions.VersionedTable:
    """The versions up to ``newest``, each written once and made from the written one before."""
    made = versions.VersionedTable(spark, workspace(spark, "customer-versions"))
    steps = (
        ("WRITE", lambda: _v0(spark, sf_dir)),
        ("UPDATE", lambda: _v1(made.read(0))),
        ("DELETE", lambda: _v2(made.read(1))),
        ("MERGE", lambda: _v3(spark, sf_dir, made.read(2))),
        ("MERGE", lambda: _v4(spark, sf_dir, made.read(3))),
    )
    for operation, snapshot in steps[: newest + 1]:
        made.commit(snapshot(), operation)
    return made


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir).history()


@query("update_where", VERSIONS_SQL + "SELECT * FROM v1")
def _update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _v1(_v0(spark, sf_dir))


@query("delete_where", VERSIONS_SQL + "SELECT * FROM v2")
def _delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _v2(_v1(_v0(spark, sf_dir)))


@query("merge_insert_only", VERSIONS_SQL + "SELECT * FROM v3")
def _insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _v3(spark, sf_dir, _table(spark, sf_dir, newest=2).read(2))


@query("merge_upsert", VERSIONS_SQL + "SELECT * FROM v4")
def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _v4(spark, sf_dir, _table(spark, sf_dir, newest=3).read(3))


@query(
    "version_diff",
    VERSIONS_SQL
    + """SELECT c_custkey, c_mktsegment, CAST(min(version) AS VARCHAR) AS versions
         FROM history WHERE version IN (0, 4) GROUP BY c_custkey, c_mktsegment
         HAVING count(*) = 1""",
)
def _diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _history(spark, sf_dir).filter(F.col(versions.VERSION).isin(0, 4))
    changed = versions.version_diff(history, [KEY], "c_mktsegment")
    listed = F.array_join(F.transform("versions", lambda v: v.cast("string")), ",")
    return changed.withColumn("versions", listed)


@query("read_version", VERSIONS_SQL + "SELECT * FROM v2")
def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.read_version(_table(spark, sf_dir, newest=3).history(), 2)


RESTORED_SQL = VERSIONS_SQL + """,
    restored AS (SELECT * FROM history UNION ALL SELECT *, 5 FROM v2)
"""


@query("restore_version", RESTORED_SQL + "SELECT * FROM restored")
def _restore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.restore_version(_history(spark, sf_dir), 2)


@query(
    "version_history",
    RESTORED_SQL
    + """, pairs AS (
        SELECT coalesce(n.version, o.version + 1) AS version,
               CASE WHEN n.c_custkey IS NULL THEN 'deleted'
                    WHEN o.c_custkey IS NULL THEN 'inserted'
                    WHEN (n.c_name, n.c_acctbal, n.c_mktsegment)
                         IS DISTINCT FROM (o.c_name, o.c_acctbal, o.c_mktsegment) THEN 'updated'
                    ELSE 'kept' END AS change
        FROM restored n FULL OUTER JOIN (SELECT * FROM restored WHERE version < 5) o
        ON n.version = o.version + 1 AND n.c_custkey = o.c_custkey)
    SELECT version, operation, count(*) FILTER (change <> 'deleted') AS rows,
           count(*) FILTER (change = 'inserted') AS inserted,
           count(*) FILTER (change = 'updated') AS updated,
           count(*) FILTER (change = 'deleted') AS deleted
    FROM pairs JOIN (VALUES (0, 'WRITE'), (1, 'UPDATE'), (2, 'DELETE'), (3, 'MERGE'), (4, 'MERGE'),
                            (5, 'RESTORE')) c(version, operation) USING (version)
    GROUP BY version, operation""",
)
def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _table(spark, sf_dir)
    made.restore(2)
    return versions.version_history(made.history(), made.commits(), KEY)


@query(
    "version_history_filtered",
    VERSIONS_SQL
    + """SELECT 1 AS version, 'UPDATE' AS operation, count(*) AS rows, 0 AS inserted,
                count(*) FILTER (v0.c_acctbal <> v1.c_acctbal
                                 OR v0.c_mktsegment <> v1.c_mktsegment) AS updated, 0 AS deleted
         FROM v0 JOIN v1 USING (c_custkey)""",
)
def _log_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _table(spark, sf_dir)
    log = versions.version_history(made.history(), made.commits(), KEY)
    return log.filter(F.col("operation") == "UPDATE")


@query(
    "avg_by_version",
    VERSIONS_SQL
    + """SELECT version, round(avg(c_acctbal), 6) AS avg_balance
         FROM history WHERE version IN (0, 4) GROUP BY version""",
)
def _average(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _history(spark, sf_dir).filter(F.col(versions.VERSION).isin(0, 4))
    averages = versions.avg_by_version(history, "c_acctbal", "avg_balance")
    return averages.withColumn("avg_balance", F.round("avg_balance", 6))
