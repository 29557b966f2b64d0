"""Data quality: validators, constraint checks, metrics, profiles, suggestions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOATS = (T.FloatType, T.DoubleType)


def _missing(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    # isnan is defined for floating point only; on text it would fail under ANSI rules.
    return value.isNull() | F.isnan(value) if isinstance(field.dataType, FLOATS) else value.isNull()


def missing_values(df: DataFrame) -> DataFrame:
    """NULL or NaN values per column, one row under the columns' own names."""
    return df.agg(*[F.count_if(_missing(f)).alias(f.name) for f in df.schema.fields])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def invalid_step(
    df: DataFrame, column: str, low: float = 0.5, high: float = 5.0, step: float = 0.5
) -> DataFrame:
    """Rows outside ``low`` to ``high`` or off the ``step`` grid; NULL is not reported."""
    value = F.col(column)
    return df.filter((value < low) | (value > high) | (value % step != 0))


def invalid_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows outside ``low`` to ``high``; NULL is not reported."""
    return df.filter((F.col(column) < low) | (F.col(column) > high))


@dataclass(frozen=True)
class Check:
    """One constraint on one column, for ``run_checks``."""

    constraint: str
    column: str
    allowed: tuple = ()

    @property
    def label(self) -> str:
        return f"{self.constraint}({self.column})"


def is_complete(column: str) -> Check:
    return Check("isComplete", column)


def is_unique(column: str) -> Check:
    return Check("isUnique", column)


def is_contained_in(column: str, allowed: Sequence) -> Check:
    return Check("isContainedIn", column, tuple(allowed))


def is_non_negative(column: str) -> Check:
    return Check("isNonNegative", column)


def _row_test(check: Check) -> Column:
    """True for a row that satisfies the check; a NULL value satisfies all but isComplete."""
    value = F.col(check.column)
    if check.constraint == "isComplete":
        return value.isNotNull()
    if check.constraint == "isContainedIn":
        return value.isNull() | value.isin(*check.allowed)
    if check.constraint == "isNonNegative":
        return value.isNull() | (value >= 0)
    raise ValueError(f"unknown constraint {check.constraint!r}")


def _unique_counts(df: DataFrame, column: str) -> DataFrame:
    """(n_total, n_good) for a uniqueness check: non-NULL rows, and those whose value is single."""
    per_value = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__n"))
    return per_value.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_total"),
        F.count_if(F.col("__n") == 1).alias("n_good"),
    )


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per constraint: share of rows that satisfy it and Success or Failure.

    Row-wise constraints share one pass; each uniqueness constraint is one group count that
    reads only its column.  An empty input satisfies everything.
    """
    row_wise = [c for c in checks if c.constraint != "isUnique"]
    frames = []
    if row_wise:
        one_row = df.agg(
            F.count("*").alias("n_total"),
            *[F.count_if(_row_test(c)).alias(f"__{i}") for i, c in enumerate(row_wise)],
        )
        rows = [
            F.struct(F.lit(c.label).alias("constraint"), "n_total", F.col(f"__{i}").alias("n_good"))
            for i, c in enumerate(row_wise)
        ]
        frames.append(one_row.select(F.inline(F.array(*rows))))
    for check in checks:
        if check.constraint == "isUnique":
            counts = _unique_counts(df, check.column)
            frames.append(counts.select(F.lit(check.label).alias("constraint"), "n_total", "n_good"))
    ratio = F.when(F.col("n_total") == 0, F.lit(1.0)).otherwise(
        F.col("n_good").cast("double") / F.col("n_total")
    )
    return reduce(DataFrame.union, frames).select(
        "constraint",
        ratio.alias("ratio"),
        F.when(ratio == 1.0, F.lit("Success")).otherwise(F.lit("Failure")).alias("status"),
    )


def run_analyzers(
    df: DataFrame, complete: str, distinct: str, mean: str, rsd: float = 0.05
) -> DataFrame:
    """Size, Completeness, ApproxCountDistinct and Mean as (metric, column_name, value) rows."""
    one_row = df.agg(
        F.count("*").cast("double").alias("size"),
        (F.count(complete) / F.count("*")).alias("completeness"),
        F.approx_count_distinct(distinct, rsd).cast("double").alias("distinct"),
        F.avg(mean).cast("double").alias("mean"),
    )
    rows = [
        F.struct(F.lit(m).alias("metric"), F.lit(c).alias("column_name"), F.col(v).alias("value"))
        for m, c, v in (
            ("Size", "*", "size"),
            ("Completeness", complete, "completeness"),
            ("ApproxCountDistinct", distinct, "distinct"),
            ("Mean", mean, "mean"),
        )
    ]
    return one_row.select(F.inline(F.array(*rows)))


def column_profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Per column: type, completeness, distinct values, and mean, min and max of numbers.

    Distinct values are estimated in the same single pass.  ``exact=True`` counts them, by one
    group count for each column that reads only that column.
    """
    return _profile(df, exact).drop("n_rows")


def distinct_count(df: DataFrame, name: str) -> DataFrame:
    """One row: the number of distinct non-NULL values of a column."""
    value = F.col(f"`{name}`").alias("__value")
    return df.select(value).where("__value IS NOT NULL").distinct().agg(F.count("*").alias("n"))


def _profile(df: DataFrame, exact: bool) -> DataFrame:
    fields = df.schema.fields
    columns = [F.count("*").alias("__rows")]
    for i, f in enumerate(fields):
        value = F.col(f"`{f.name}`")
        columns.append(F.count(value).alias(f"__n{i}"))
        if not exact:
            columns.append(F.approx_count_distinct(value).alias(f"__d{i}"))
        if isinstance(f.dataType, T.NumericType):
            columns += [
                F.avg(value).cast("double").alias(f"__a{i}"),
                F.min(value).cast("double").alias(f"__l{i}"),
                F.max(value).cast("double").alias(f"__h{i}"),
            ]
    rows = []
    for i, f in enumerate(fields):
        numeric = isinstance(f.dataType, T.NumericType)
        distinct = distinct_count(df, f.name).scalar() if exact else F.col(f"__d{i}")
        stats = [F.col(f"__{s}{i}") if numeric else F.lit(None).cast("double") for s in "alh"]
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.try_divide(F.col(f"__n{i}").cast("double"), F.col("__rows")).alias("completeness"),
                distinct.alias("distinct_values"),
                *[s.alias(n) for s, n in zip(stats, ("mean", "min_value", "max_value"), strict=True)],
                F.col("__rows").alias("n_rows"),
            )
        )
    return df.agg(*columns).select(F.inline(F.array(*rows)))


# A column is called categorical up to this many distinct values, and up to
# this share of distinct values among its rows.
CATEGORY_VALUES = 25
CATEGORY_RATIO = 0.1


#: Relative standard deviation of estimated distinct counts, Spark's default.
RSD = 0.05


def suggest_constraints(df: DataFrame, exact: bool = False) -> DataFrame:
    """Constraints that the profile supports, as (column_name, suggestion) rows.

    By default distinct values are estimated: columns whose estimate leaves "unique" or
    "categorical" open (within ten standard deviations) are then counted, each by a group
    count of its own.  The estimates are read first, one row for each column.
    """
    profile = _profile(df, exact)
    if not exact:
        near = 10 * RSD  # the count decides, so a wide margin costs time only and a miss is negligible
        n, d = F.col("n_rows"), F.col("distinct_values")
        may_be_unique = (F.col("completeness") == 1.0) & (d >= n * (1 - near))
        may_be_category = (d <= CATEGORY_VALUES * (1 + near)) & (d <= n * CATEGORY_RATIO * (1 + near))
        open_ = [r[0] for r in profile.where(may_be_unique | may_be_category).select("column_name").collect()]
        counted = F.col("distinct_values")
        for name in open_:
            counted = F.when(F.col("column_name") == name, distinct_count(df, name).scalar()).otherwise(counted)
        known = F.col("column_name").isin(*open_) if open_ else F.lit(False)
        profile = profile.withColumn("distinct_values", F.when(known, counted))
    rules: Mapping[str, Column] = {
        "complete": F.col("completeness") == 1.0,
        "unique": (F.col("completeness") == 1.0) & (F.col("distinct_values") == F.col("n_rows")),
        "non_negative": F.col("min_value") >= 0,
        "categorical": (F.col("distinct_values") <= CATEGORY_VALUES)
        & (F.col("distinct_values") <= F.col("n_rows") * CATEGORY_RATIO),
    }
    found = F.filter(
        F.array(*[F.when(test, F.lit(name)) for name, test in rules.items()]),
        lambda name: name.isNotNull(),
    )
    return profile.select("column_name", F.explode(found).alias("suggestion"))
