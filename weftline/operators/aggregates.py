"""Aggregations.  All of them combine partial results before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.workspace import materialize

FUNCTIONS = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


def calculate_aggregate(
    df: DataFrame, group: str | Sequence[str], column: str, function: str, alias: str
) -> DataFrame:
    """One named aggregate per group; an unknown function name is an error."""
    if function not in FUNCTIONS:
        raise ValueError(f"unknown aggregate {function!r}; known: {', '.join(FUNCTIONS)}")
    keys = [group] if isinstance(group, str) else list(group)
    return df.groupBy(*keys).agg(FUNCTIONS[function](column).alias(alias))


def agg_named(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column]) -> DataFrame:
    """Several aggregates per group, each under its own name (no keys: over all rows)."""
    columns = [expression.alias(name) for name, expression in aggregates.items()]
    return df.groupBy(*keys).agg(*columns) if keys else df.agg(*columns)


def count_rows(df: DataFrame, alias: str = "n") -> DataFrame:
    return df.agg(F.count("*").alias(alias))


def count_column(df: DataFrame, key: str, column: str, alias: str = "n") -> DataFrame:
    """Non-NULL values of ``column`` per key; a group of NULLs shows 0."""
    return df.groupBy(key).agg(F.count(column).alias(alias))


def sum_of_terms(*columns: str) -> Column:
    """``SUM(a + b + ..)``: a row with a NULL term adds nothing, as in SQL."""
    total = F.col(columns[0])
    for name in columns[1:]:
        total = total + F.col(name)
    return F.sum(total)


def collect_values(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    alias: str,
    spread_by: Sequence[str],
    min_size: int = 1,
    max_size: int | None = None,
    part_rows: int = 100_000,
) -> DataFrame:
    """Sorted non-NULL values per group, for groups of ``min_size`` to ``max_size`` values.

    Adds ``size`` (values in the whole group) and ``part``: every row holds ``part_rows``
    neighbouring values of its group's sorted list, the last part the rest.  ``spread_by`` names
    columns that tell rows with equal values apart.

    With ``max_size`` each task first limits a group to one value more than that.  Without it the
    rows are range-partitioned by group and value, written to the workspace and numbered by
    partition and offset, so that no task has to hold a large group; this runs a job.
    """
    extra = [c for c in spread_by if c not in (*keys, column)]
    values = df.select(*keys, column, *extra).where(F.col(column).isNotNull())
    if max_size is not None:
        first = Window.partitionBy(*keys).orderBy(column, *extra)
        few = values.withColumn("__rank", F.row_number().over(first)).where(
            F.col("__rank") <= max_size + 1
        )
        lists = few.groupBy(*keys).agg(
            F.count("*").alias("size"), F.array_sort(F.collect_list(column)).alias("__all")
        )
        starts = F.sequence(F.lit(0), F.floor((F.col("size") - 1) / part_rows).cast("int"))
        parts = F.transform(starts, lambda i: F.slice("__all", i * part_rows + 1, part_rows))
        kept = lists.where(F.col("size").between(min_size, max_size))
        return kept.select(*keys, "size", F.posexplode(parts).alias("part", alias))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = values.repartitionByRange(n, *keys, column, *extra)
    ranged = materialize(ranged.withColumn("__range", F.spark_partition_id()), "ranged-values")
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(*keys, "__range").agg(F.count("*").alias("__n"))
    offsets = offsets.select(
        *[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)],
        F.col("__range").alias("__in"),
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
        F.sum("__n").over(group).alias("size"),
    ).where(F.col("size") >= min_size)
    same = [F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)]
    inside = Window.partitionBy(*keys, "__range").orderBy(column, *extra)
    numbered = ranged.withColumn("__number", F.row_number().over(inside) - 1)
    rank = F.col("__before") + F.col("__number")
    placed = numbered.join(offsets, [*same, F.col("__range") == F.col("__in")]).withColumn(
        "part", F.floor(rank / part_rows).cast("int")
    )
    return placed.groupBy(*keys, "size", "part").agg(
        F.array_sort(F.collect_list(column)).alias(alias)
    )


def value_counts(df: DataFrame, column: str, alias: str = "n") -> DataFrame:
    """Frequency of each value, most frequent first; equal counts in value order."""
    counts = df.groupBy(column).agg(F.count("*").alias(alias))
    return counts.orderBy(F.desc(alias), F.col(column))


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min and max per column, one row each, from one pass."""
    statistics = {
        "count": lambda c: F.count(c).cast("double"),
        "mean": F.avg,
        "stddev": F.stddev,
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    one_row = df.agg(
        *[f(c).alias(f"{c}__{name}") for c in columns for name, f in statistics.items()]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[
                F.col(f"`{c}__{name}`").alias(as_)
                for name, as_ in zip(
                    statistics, ("n", "mean", "stddev", "min_value", "max_value"), strict=True
                )
            ],
        )
        for c in columns
    ]
    return one_row.select(F.inline(F.array(*rows)))
