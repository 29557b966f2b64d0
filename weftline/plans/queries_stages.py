"""Queries: stage metrics, on metrics rows made from lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import stage_metrics
from weftline.plans.registry import query, table

MB = 1024 * 1024

# How each metric follows from a group's totals (q = quantity, d = discount in
# hundredths, n = rows, first and last = shipping days since 1995).  The expressions read the
# same in Spark and in the check, so that times, sizes and zero values all occur.
METRICS = {
    "numTasks": "n",
    "submissionTime": "first * 100",
    "completionTime": "last * 100 + q",
    "stageDuration": "(last - first) * 100 + q",
    "executorRunTime": "CASE WHEN d = 0 THEN 0 ELSE q * 1000 END",
    "executorCpuTime": "q * 700 + d * 10000",
    "executorDeserializeTime": "d * 400",
    "executorDeserializeCpuTime": "d * 300",
    "resultSerializationTime": "n * 40",
    "jvmGCTime": "q * 50 + d * 100",
    "resultSize": "q * 4096",
    "diskBytesSpilled": "CASE WHEN n > 3 THEN q * 65536 ELSE 0 END",
    "memoryBytesSpilled": "CASE WHEN n > 4 THEN q * 131072 ELSE 0 END",
    "peakExecutionMemory": "q * 16777216",
    "recordsRead": "q * 1000",
    "bytesRead": "q * 100000",
    "recordsWritten": "n * 10",
    "bytesWritten": "n * 10000",
    "shuffleFetchWaitTime": "d * 60",
    "shuffleTotalBytesRead": "q * 5000",
    "shuffleLocalBytesRead": "q * 2000",
    "shuffleRemoteBytesRead": "q * 3000",
    "shuffleRemoteBytesReadToDisk": "n * 7",
    "shuffleWriteTime": "n * 250",
    "shuffleBytesWritten": "d * 3000",
}

STAGES_SQL = f"""
    WITH totals AS (
        SELECT CAST(l_linenumber AS BIGINT) AS "jobId", l_partkey AS "stageId", count(*) AS n,
               CAST(sum(l_quantity) AS BIGINT) AS q,
               CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS d,
               min(CAST(l_shipdate AS DATE) - DATE '1995-01-01') AS first,
               max(CAST(l_shipdate AS DATE) - DATE '1995-01-01') AS last
        FROM lineitem GROUP BY ALL),
    stages AS (SELECT "jobId", "stageId",
        {", ".join(f'CAST({e} AS BIGINT) AS "{name}"' for name, e in METRICS.items())} FROM totals)
"""


def _stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")).cast("long")
    totals = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_linenumber").cast("long").alias("jobId"), F.col("l_partkey").alias("stageId"))
        .agg(
            F.count("*").alias("n"),
            F.sum("l_quantity").cast("long").alias("q"),
            F.sum(F.round(F.col("l_discount") * 100).cast("long")).alias("d"),
            F.min(day).alias("first"),
            F.max(day).alias("last"),
        )
    )
    metrics = [f"CAST({e} AS BIGINT) AS {name}" for name, e in METRICS.items()]
    return totals.selectExpr("jobId", "stageId", *metrics)


def _share(part: str, whole: str, limit: float) -> str:
    return f'coalesce(CAST({part} AS DOUBLE) / nullif("{whole}", 0) > {limit}, false)'


FLAGS_SQL = f"""
    {_share('"executorCpuTime"', "executorRunTime", 0.8)} AS is_cpu_bound,
    {_share('"jvmGCTime"', "executorRunTime", 0.1)} AS is_memory_bound,
    {_share('("shuffleFetchWaitTime" + "shuffleWriteTime")', "stageDuration", 0.5)} AS is_network_bound,
    "diskBytesSpilled" + "memoryBytesSpilled" > 0 AS is_spill,
    {_share('"executorDeserializeTime"', "executorRunTime", 0.2)} AS is_deserialize_heavy,
    "shuffleFetchWaitTime" + "shuffleWriteTime" > 1000 AS is_shuffle,
    {_share('"resultSerializationTime"', "stageDuration", 0.1)} AS is_serialization,
    "peakExecutionMemory" > 1073741824 AS is_storage
"""

FLAGS = (
    "is_cpu_bound",
    "is_memory_bound",
    "is_network_bound",
    "is_spill",
    "is_deserialize_heavy",
    "is_shuffle",
    "is_serialization",
    "is_storage",
)


@query("classify_stages", STAGES_SQL + f'SELECT "jobId", "stageId", {FLAGS_SQL} FROM stages')
def _classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = stage_metrics.classify_stages(_stages(spark, sf_dir))
    return flagged.select("jobId", "stageId", *FLAGS)


@query(
    "flag_slow_stages",
    STAGES_SQL
    + """SELECT "stageId", 'high_exec' AS reason FROM stages WHERE "executorRunTime" > 100000
         UNION ALL SELECT "stageId", 'high_gc' FROM stages WHERE "jvmGCTime" > 5000
         UNION ALL SELECT "stageId", 'high_shuffle' FROM stages
                   WHERE "shuffleFetchWaitTime" > 1000 OR "shuffleWriteTime" > 1000""",
)
def _slow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_metrics.flag_slow_stages(_stages(spark, sf_dir))


UNITS_SQL = ", ".join(
    [f'"{c}" / 60000.0::DOUBLE AS "{c}_minutes"' for c in stage_metrics.MINUTE_COLUMNS]
    + [f'"{c}" / {MB}.0::DOUBLE AS "{c}_MBs"' for c in stage_metrics.MB_COLUMNS]
)


@query("metrics_to_units", STAGES_SQL + f"SELECT *, {UNITS_SQL} FROM stages")
def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_metrics.metrics_to_units(_stages(spark, sf_dir))


@query(
    "stage_report",
    STAGES_SQL
    + f"""SELECT *, {FLAGS_SQL}, {UNITS_SQL} FROM stages
          ORDER BY "executorRunTime" DESC, "jvmGCTime" DESC, "shuffleFetchWaitTime" DESC,
                   "shuffleWriteTime" DESC""",
)
def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_metrics.stage_report(_stages(spark, sf_dir))


_ELAPSED = 'max("completionTime") - min("submissionTime")'
SUMMARY_SQL = f"""
    count(*) AS "numStages", CAST(sum("numTasks") AS BIGINT) AS "numTasks",
    ({_ELAPSED}) / 1000.0::DOUBLE AS "elapsedTime_seconds",
    ({_ELAPSED}) / 60000.0::DOUBLE AS "elapsedTime_minutes",
    max("peakExecutionMemory") / {MB}.0::DOUBLE AS "peakExecutionMemory_MBs",
    CAST(sum("recordsRead") AS BIGINT) AS "recordsRead",
    CAST(sum("recordsWritten") AS BIGINT) AS "recordsWritten",
""" + ", ".join(
    [
        f'CAST(sum("{c}") AS DOUBLE) / {unit} AS "{c}_{name}"'
        for c in ("executorRunTime", "executorCpuTime", "jvmGCTime")
        for name, unit in (("seconds", 1000), ("minutes", 60000))
    ]
    + [
        f'CAST(sum("{c}") AS DOUBLE) / {MB} AS "{c}_MBs"'
        for c in ("shuffleTotalBytesRead", "shuffleBytesWritten", "bytesRead", "bytesWritten")
    ]
)


@query(
    "summarize_metrics",
    STAGES_SQL + f'SELECT "jobId", {SUMMARY_SQL} FROM stages GROUP BY "jobId"',
)
def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_metrics.summarize_metrics(_stages(spark, sf_dir), "jobId")


@query("summarize_metrics_total", STAGES_SQL + f"SELECT {SUMMARY_SQL} FROM stages")
def _summary_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_metrics.summarize_metrics(_stages(spark, sf_dir))
