"""Table versions as DataFrames.

A version is a snapshot; a history holds snapshots with a ``version`` column, and is best
stored partitioned by it, so that reading one version reads one folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.skew import deal

VERSION = "version"


def with_version(snapshot: DataFrame, version: int) -> DataFrame:
    return snapshot.withColumn(VERSION, F.lit(version))


def version_diff(history: DataFrame, keys: Sequence[str], attribute: str) -> DataFrame:
    """(keys, attribute) pairs that occur once over all versions, with the version they are in.

    A pair that occurs once has one version to list, so a count and a minimum say what a
    collected list of versions would, and both combine before the shuffle.
    """
    return (
        history.groupBy(*keys, attribute)
        .agg(F.count("*").alias("__n"), F.min(VERSION).alias("__v"))
        .where(F.col("__n") == 1)
        .select(*keys, attribute, F.array("__v").alias("versions"))
    )


def update_where(df: DataFrame, condition: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """Set columns on rows that satisfy the condition; a NULL condition leaves the row alone."""
    return df.withColumns(
        {name: F.when(condition, value).otherwise(F.col(name)) for name, value in assignments.items()}
    )


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows that satisfy the condition; a NULL condition keeps the row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def _together(target: DataFrame, source: DataFrame, key: str, rows_per_part: int) -> DataFrame:
    """Both sides' rows with ``__source`` and, of their key, ``__targets`` and ``__sources``.

    One shuffle brings the rows of a key together.  Keys that a sketch finds hot on a side are split
    there and their rows of the other side copied into every part (``__copied``), so the two numbers
    are those of the part.  ``__first`` marks one copy of each target row.
    """
    dealt = deal(target, source, key, key, rows_per_part)
    tagged = []
    for number, side in enumerate((target, source)):
        cells = dealt.side(side.select(*target.columns), F.col(key), number)
        tagged.append(
            cells.withColumn("__source", F.lit(bool(number))).withColumn("__first", F.col("__cell1") == 0)
        )
    together = Window.partitionBy(key, "__cell0", "__cell1")
    return (
        tagged[0]
        .unionByName(tagged[1])
        .withColumn("__targets", F.count_if(~F.col("__source")).over(together))
        .withColumn("__sources", F.count_if(F.col("__source")).over(together))
    )


def _is_new() -> Column:
    """Whether a source row's key is in no target row; a copied one's is hot there."""
    return ~F.col("__copied") & (F.col("__targets") == 0)


def merge_insert_only(
    target: DataFrame, source: DataFrame, key: str, rows_per_part: int = 1_000_000
) -> DataFrame:
    """Add the source rows that match no target row; a NULL key matches nothing."""
    rows = _together(target, source, key, rows_per_part)
    new = F.col(key).isNull() | _is_new()
    return rows.where(F.when(F.col("__source"), new).otherwise(F.col("__first"))).select(*target.columns)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    columns: Sequence[str],
    rows_per_part: int = 1_000_000,
) -> DataFrame:
    """Update ``columns`` where a source row matches, insert the source rows that match none.

    Two source rows for one target row are an error when the result is computed.  Target and source
    are read once and meet in one shuffle; keys that repeat very often are spread over tasks.
    """
    rows = _together(target, source, key, rows_per_part)
    matched = F.col(key).isNotNull() & (F.col("__sources") > 0)
    # A copied target row's key has several source rows, of which a part may hold one.
    ambiguous = ~F.col("__source") & matched & (F.col("__copied") | (F.col("__sources") > 1))
    error = F.raise_error(
        F.concat(F.lit("several source rows match the target row with key "), F.col(key).cast("string"))
    )
    together = Window.partitionBy(key, "__cell0", "__cell1")
    changes = F.when(F.col("__source"), F.struct(*[F.col(c) for c in columns]))
    change = F.first(changes, ignorenulls=True).over(together)
    # The guard is part of the one filter, so that it runs whatever columns are read.
    kept = (
        F.when(ambiguous, error.cast("boolean"))
        .when(F.col("__source"), F.col(key).isNull() | _is_new())
        .otherwise(F.col("__first"))
    )
    updates = ~F.col("__source") & matched
    changed = {c: F.when(updates, F.col(f"__change.`{c}`")).otherwise(F.col(c)) for c in columns}
    return rows.withColumn("__change", change).where(kept).withColumns(changed).select(*target.columns)


def read_version(history: DataFrame, version: int) -> DataFrame:
    """The table as of a version; only that version's folder is read."""
    return history.filter(F.col(VERSION) == version).drop(VERSION)


def restore_version(history: DataFrame, version: int) -> DataFrame:
    """The history with an old snapshot appended as its newest version.

    Looks up that the version exists; a version the history lacks is an error.
    """
    old = read_version(history, version)
    if old.isEmpty():
        raise ValueError(f"the history has no version {version}")
    newest = history.agg(F.max(VERSION)).scalar()
    return history.unionByName(old.withColumn(VERSION, (newest + 1).cast(history.schema[VERSION].dataType)))


class VersionedTable:
    """Snapshots in ``root/data/version=N`` and a log of (version, operation) in ``root/log``.

    Every commit writes its snapshot once and records what made it; later snapshots are built from
    the written ones.  Commits of one table are made by one writer at a time.
    """

    LOG = "version INT, operation STRING"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def commits(self) -> DataFrame:
        """The log; empty before the first commit."""
        try:
            return self.spark.read.schema(self.LOG).parquet(f"{self.root}/log")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.LOG)

    def newest(self) -> int:
        """The newest version, -1 before the first commit."""
        return self.commits().agg(F.coalesce(F.max("version"), F.lit(-1))).first()[0]

    def commit(self, snapshot: DataFrame, operation: str) -> int:
        """Write a snapshot as the next version, then its log row: an unlogged snapshot is none."""
        version = self.newest() + 1
        snapshot.write.mode("overwrite").parquet(f"{self.root}/data/{VERSION}={version}")
        entry = self.spark.createDataFrame([(version, operation)], self.LOG)
        entry.coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        return version

    def history(self) -> DataFrame:
        """All logged snapshots, with their version."""
        written = self.spark.read.parquet(f"{self.root}/data")
        return written.where(F.col(VERSION) <= self.newest())

    def read(self, version: int) -> DataFrame:
        """One snapshot; only its folder is read."""
        if not 0 <= version <= self.newest():
            raise ValueError(f"the table has no version {version}")
        return self.spark.read.parquet(f"{self.root}/data/{VERSION}={version}")

    def restore(self, version: int) -> int:
        """Commit an old snapshot again."""
        return self.commit(self.read(version), "RESTORE")


def row_fingerprint(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Four 32-bit numbers of a row, from two 64-bit hashes: sums of them compare sets of rows.

    Sums do not depend on the order of rows, count repeated ones, and add up before a shuffle; 2**31
    rows fit.  Which values are NULL is part of the hash; nested values count as JSON text.
    """
    parts: list[Column] = [F.lit(len(columns))]
    for name in columns:
        value = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType)):
            value = F.to_json(value, {"ignoreNullFields": "false"})
        parts += [value.isNull(), value]
    hashes = [F.xxhash64(F.lit(seed), *parts) for seed in (0, 1)]
    low = F.lit(0xFFFFFFFF)
    return [half for h in hashes for half in (F.shiftright(h, 32), h.bitwiseAND(low))]


def version_history(history: DataFrame, commits: DataFrame, key: str) -> DataFrame:
    """Per commit: operation, rows in the version, and keys inserted, updated and deleted.

    ``commits`` is the log with (version, operation), one row per version.  Each row is laid
    against the same key of the version before by grouping, not by joining: a row counts as
    new in its own version and as old in the next.  A key's rows, one or several, have changed if
    the sums of their fingerprints differ.
    """
    prints = row_fingerprint(history, [c for c in history.columns if c not in (VERSION, key)])
    sides = history.select(
        F.col(key).alias("__key"),
        *[p.alias(f"__print{i}") for i, p in enumerate(prints)],
        F.explode(
            F.array(
                F.struct(F.col(VERSION).alias("v"), F.lit(True).alias("new")),
                F.struct((F.col(VERSION) + 1).alias("v"), F.lit(False).alias("new")),
            )
        ).alias("__at"),
    )
    is_new = F.col("__at.new")
    numbers = [F.col(f"__print{i}") for i in range(len(prints))]
    pairs = sides.groupBy(F.col("__at.v").alias(VERSION), "__key").agg(
        F.count_if(is_new).alias("n_new"),
        F.count_if(~is_new).alias("n_old"),
        *[F.sum(F.when(is_new, n).otherwise(-n)).alias(f"__by{i}") for i, n in enumerate(numbers)],
    )
    present, before = F.col("n_new") > 0, F.col("n_old") > 0
    changed = F.col("n_new") != F.col("n_old")
    for i in range(len(prints)):
        changed |= F.col(f"__by{i}") != 0
    changes = pairs.groupBy(VERSION).agg(
        F.sum("n_new").alias("rows"),
        F.count_if(present & ~before).alias("inserted"),
        F.count_if(present & before & changed).alias("updated"),
        F.count_if(~present).alias("deleted"),
    )
    counts = ("rows", "inserted", "updated", "deleted")
    return commits.join(changes, VERSION, "left").select(
        VERSION, "operation", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts]
    )


def avg_by_version(history: DataFrame, column: str, alias: str) -> DataFrame:
    return history.groupBy(VERSION).agg(F.avg(column).alias(alias))
