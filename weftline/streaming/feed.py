"""Feeding a table to a stream in order of event time, and accounting for every row of it."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.layout import total_bytes
from weftline.sources.sinks import write_parquet
from weftline.streaming import run, sources
from weftline.workspace import workspace

BATCH_BYTES = 1 << 30
ARRIVED = "arrived"

Build = Callable[[DataFrame], DataFrame]


def time_slices(df: DataFrame, time: str, batch_bytes: int = BATCH_BYTES) -> Iterator[DataFrame]:
    """``df`` in slices of at most about ``batch_bytes`` of data, each later in ``time`` than the last.

    The table is cut once, by a range partitioning that is written with a folder for each slice; a
    table of one slice isn't written.  Rows of one time stay together, rows without a time come first.
    """
    count = math.ceil(total_bytes(df) / batch_bytes)
    if count <= 1:
        yield df
        return
    path = workspace(df.sparkSession, "time-slices")
    cut = df.repartitionByRange(count, time).withColumn("__slice", F.spark_partition_id())
    cut.write.partitionBy("__slice").parquet(path)
    written = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("__slice", T.IntegerType())]))
    for number in range(count):
        yield written.parquet(path).where(F.col("__slice") == number).drop("__slice")


@dataclass
class Account:
    """What became of the rows that arrived at a windowed count."""

    arrived: int = 0
    dropped_groups: int = 0


class Feed:
    """One running query over an inbox folder; rows that are put there are processed at once.

    ``build`` makes the query from the stream of arrived rows; its results are appended to files at
    ``out``.  The query starts with the first rows and is stopped at the end of the ``with`` block.
    """

    def __init__(self, spark: SparkSession, schema: T.StructType, build: Build, purpose: str):
        self.inbox, self.out = workspace(spark, f"{purpose}-inbox"), workspace(spark, purpose)
        self.checkpoint = f"{self.out}/_checkpoints"
        self.account = Account()
        self.parts, self.spark, self.query, self.seen = 0, spark, None, -1
        arriving = sources.file_stream(spark, f"{self.inbox}/part=*", schema).select(*schema.names)
        observed = arriving.observe(ARRIVED, F.count(F.lit(1)).alias("rows"))
        self.result = build(observed)

    def __enter__(self) -> Feed:
        return self

    def __exit__(self, *error) -> None:
        if self.query is not None:
            self.query.stop()

    def put(self, rows: DataFrame) -> None:
        """Write rows to the inbox and wait until they, and what they close, are processed."""
        write_parquet(rows, f"{self.inbox}/part={self.parts}")
        self.parts += 1
        if self.query is None:
            writer = run.table_writer(self.result, self.out, self.checkpoint)
            self.query = run.start(writer, self.spark)
        self.query.processAllAvailable()
        for progress in self.query.recentProgress:
            if progress.batchId > self.seen:
                self.seen = progress.batchId
                self._add(progress)

    def _add(self, progress) -> None:
        counted = progress.observedMetrics.get(ARRIVED)
        self.account.arrived += counted["rows"] if counted is not None else 0
        self.account.dropped_groups += sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)

    def table(self) -> DataFrame:
        """What the query has written."""
        return self.spark.read.schema(self.result.schema).parquet(self.out)

    def state(self) -> DataFrame:
        """The (key, value) rows of the query's state after its last batch."""
        return self.spark.read.format("statestore").load(self.checkpoint)

    def totals(self, counted: Column, held: Column) -> DataFrame:
        """``arrived``, ``kept``, ``open`` and ``dropped`` rows, of a query that counts rows once each.

        Kept are the rows that ``counted`` says its results hold, open those that ``held`` says its
        state holds; the rest came behind the watermark.  Spark itself counts what the watermark
        drops in groups of rows that one task put together, which depend on the tasks.
        """
        kept = self.table().agg(F.coalesce(F.sum(counted), F.lit(0)).alias("kept"))
        waiting = self.state().agg(F.coalesce(F.sum(held), F.lit(0)).alias("open"))
        arrived = F.lit(self.account.arrived).cast("long")
        one = kept.select(F.lit(1).alias("__one"), "kept").join(waiting.select(F.lit(1).alias("__one"), "open"), "__one")
        return one.select(
            arrived.alias("arrived"), "kept", "open", (arrived - F.col("kept") - F.col("open")).alias("dropped")
        )


def run_in_order(
    df: DataFrame, time: str, build: Build, purpose: str, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """The results of a stream that is fed ``df`` slice by slice in order of ``time``.

    Later slices hold later rows, so the watermark drops none, and state of what is closed is gone
    before the next slice.  ``batch_bytes`` bounds what one batch reads, whatever the table's size.
    """
    with Feed(df.sparkSession, df.schema, build, purpose) as feed:
        for rows in time_slices(df, time, batch_bytes):
            feed.put(rows)
        return feed.table()
