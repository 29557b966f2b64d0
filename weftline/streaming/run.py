"""Starting streaming queries: sinks, triggers, one checkpoint per query."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from weftline.workspace import workspace

# What queries are started with where the session says nothing else: state on the executors'
# disks with incremental checkpoints instead of on the heap, and session rows merged inside
# each task before the shuffle.
DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def set_defaults(spark: SparkSession) -> None:
    """Set what DEFAULTS names and the session does not, once and for good.

    The settings concern streams only, so batch queries planned meanwhile are not touched.
    """
    for name, value in DEFAULTS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def start(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Start a query with the DEFAULTS.

    The session's shuffle partitions become the query's state partitions and stay in its checkpoint.
    """
    set_defaults(spark)
    return writer.start()


def table_writer(
    stream: DataFrame, path: str, checkpoint: str | None = None, fmt: str = "parquet"
) -> DataStreamWriter:
    """An append writer to files at ``path``; the checkpoint defaults to a folder inside it."""
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint or f"{path}/_checkpoints")
        .option("path", path)
    )


def start_micro_batch(
    stream: DataFrame, path: str, checkpoint: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Append to a table in micro-batches, as soon as possible or at a fixed interval."""
    writer = table_writer(stream, path, checkpoint)
    return start(writer.trigger(processingTime=every) if every else writer, stream.sparkSession)


def start_continuous(
    stream: DataFrame, fmt: str, checkpoint: str, every: str = "100 milliseconds", **options
) -> StreamingQuery:
    """Row-by-row processing for map-only streams; ``fmt`` must support it (kafka, console, memory)."""
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(continuous=every)
        .start()
    )


def start_tables(
    streams: Mapping[str, DataFrame], root: str, fmt: str = "parquet", available_now: bool = False
) -> dict[str, StreamingQuery]:
    """One append query per stream, each to ``root/name`` with its own checkpoint."""
    started = {}
    for name, stream in streams.items():
        writer = table_writer(stream, f"{root}/{name}", fmt=fmt)
        if available_now:
            writer = writer.trigger(availableNow=True)
        started[name] = start(writer, stream.sparkSession)
    return started


def drain(query: StreamingQuery) -> None:
    """Wait until a query that reads what is available now has ended; its error is raised here."""
    try:
        query.awaitTermination()
    finally:
        query.stop()


def append_available(stream: DataFrame, path: str, checkpoint: str | None = None) -> None:
    """Process everything that is there now and append the results to files at ``path``."""
    writer = table_writer(stream, path, checkpoint).trigger(availableNow=True)
    drain(start(writer, stream.sparkSession))


def run_to_table(stream: DataFrame, purpose: str) -> DataFrame:
    """``append_available`` to a new folder of the workspace, and the written table."""
    spark = stream.sparkSession
    path = workspace(spark, purpose)
    append_available(stream, path)
    return spark.read.schema(stream.schema).parquet(path)
