"""Analysis of Spark stage metrics (one row per stage, times in ms, sizes in bytes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions.units import to_mb, to_minutes, to_seconds

# Thresholds of the stage report.
CPU_SHARE = 0.8
GC_SHARE = 0.1
NETWORK_SHARE = 0.5
DESERIALIZE_SHARE = 0.2
SHUFFLE_MS = 1000
SERIALIZATION_SHARE = 0.1
STORAGE_BYTES = 1024 * 1024 * 1024
SLOW_RUN_MS = 100_000
SLOW_GC_MS = 5000
SLOW_SHUFFLE_MS = 1000

# Columns reported in minutes and in MB.
MINUTE_COLUMNS = (
    "stageDuration",
    "executorRunTime",
    "executorCpuTime",
    "executorDeserializeTime",
    "executorDeserializeCpuTime",
    "resultSerializationTime",
    "jvmGCTime",
    "shuffleFetchWaitTime",
    "shuffleWriteTime",
)
MB_COLUMNS = (
    "resultSize",
    "diskBytesSpilled",
    "memoryBytesSpilled",
    "peakExecutionMemory",
    "bytesRead",
    "bytesWritten",
    "shuffleTotalBytesRead",
    "shuffleLocalBytesRead",
    "shuffleRemoteBytesRead",
    "shuffleRemoteBytesReadToDisk",
    "shuffleBytesWritten",
)
REPORT_ORDER = ("executorRunTime", "jvmGCTime", "shuffleFetchWaitTime", "shuffleWriteTime")


def _share_above(part: Column, whole: str, limit: float) -> Column:
    """``part / whole > limit``; a stage without that time has no share and is not flagged."""
    return F.coalesce(F.try_divide(part, F.col(whole)) > limit, F.lit(False))


def classify_stages(df: DataFrame) -> DataFrame:
    """Add eight flags that say what a stage spent its time or memory on."""
    shuffle = F.col("shuffleFetchWaitTime") + F.col("shuffleWriteTime")
    return df.withColumns(
        {
            "is_cpu_bound": _share_above(F.col("executorCpuTime"), "executorRunTime", CPU_SHARE),
            "is_memory_bound": _share_above(F.col("jvmGCTime"), "executorRunTime", GC_SHARE),
            "is_network_bound": _share_above(shuffle, "stageDuration", NETWORK_SHARE),
            "is_spill": F.col("diskBytesSpilled") + F.col("memoryBytesSpilled") > 0,
            "is_deserialize_heavy": _share_above(
                F.col("executorDeserializeTime"), "executorRunTime", DESERIALIZE_SHARE
            ),
            "is_shuffle": shuffle > SHUFFLE_MS,
            "is_serialization": _share_above(
                F.col("resultSerializationTime"), "stageDuration", SERIALIZATION_SHARE
            ),
            "is_storage": F.col("peakExecutionMemory") > STORAGE_BYTES,
        }
    )


def flag_slow_stages(df: DataFrame) -> DataFrame:
    """One (stageId, reason) row per limit a stage exceeds: high_exec, high_gc, high_shuffle."""
    reasons = {
        "high_exec": F.col("executorRunTime") > SLOW_RUN_MS,
        "high_gc": F.col("jvmGCTime") > SLOW_GC_MS,
        "high_shuffle": (F.col("shuffleFetchWaitTime") > SLOW_SHUFFLE_MS)
        | (F.col("shuffleWriteTime") > SLOW_SHUFFLE_MS),
    }
    found = F.filter(
        F.array(*[F.when(test, F.lit(name)) for name, test in reasons.items()]),
        lambda name: name.isNotNull(),
    )
    return df.select("stageId", F.explode(found).alias("reason"))


def metrics_to_units(df: DataFrame) -> DataFrame:
    """Add the time columns in minutes and the size columns in MB."""
    return df.withColumns(
        {f"{c}_minutes": to_minutes(c) for c in MINUTE_COLUMNS}
        | {f"{c}_MBs": to_mb(c) for c in MB_COLUMNS}
    )


def stage_report(df: DataFrame) -> DataFrame:
    """Flags and units, the costliest stages first."""
    return metrics_to_units(classify_stages(df)).orderBy(*REPORT_ORDER, ascending=False)


# What the job summary adds up.
SUMMED = (
    "numTasks",
    "executorRunTime",
    "executorCpuTime",
    "jvmGCTime",
    "shuffleTotalBytesRead",
    "shuffleBytesWritten",
    "recordsRead",
    "bytesRead",
    "recordsWritten",
    "bytesWritten",
)


def summarize_metrics(df: DataFrame, *keys: str) -> DataFrame:
    """Totals per job (or over all stages): counts, times in s and min, sizes in MB.

    Elapsed time runs from the first submission to the last completion; peak memory is the
    largest of any stage.
    """
    totals = df.groupBy(*keys).agg(
        F.count("*").alias("numStages"),
        (F.max("completionTime") - F.min("submissionTime")).alias("elapsedTime"),
        F.max("peakExecutionMemory").alias("peakExecutionMemory"),
        *[F.sum(c).alias(c) for c in SUMMED],
    )
    times = ("elapsedTime", "executorRunTime", "executorCpuTime", "jvmGCTime")
    sizes = (
        "peakExecutionMemory",
        "shuffleTotalBytesRead",
        "shuffleBytesWritten",
        "bytesRead",
        "bytesWritten",
    )
    return totals.select(
        *keys,
        "numStages",
        "numTasks",
        *[to_seconds(c).alias(f"{c}_seconds") for c in times],
        *[to_minutes(c).alias(f"{c}_minutes") for c in times],
        *[to_mb(c).alias(f"{c}_MBs") for c in sizes],
        "recordsRead",
        "recordsWritten",
    )
