"""Sorts, previews and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.workspace import materialize


def sort_desc(df: DataFrame, column: str, *tie_breakers: str, write_first: bool = False) -> DataFrame:
    """Global descending order.

    A range-partitioned sort puts equal keys into one task.  Name tie breakers when a single
    value may hold a large share of the rows, so that the range can be cut inside that value.

    Spark samples the rows to cut ranges and then makes them again to sort them.  With
    ``write_first`` they are made once, by a job that writes them to the workspace, and sample and
    sort read the table; use it where joins or groupings are below the sort.
    """
    rows = materialize(df, "unsorted") if write_first else df
    return rows.orderBy(F.desc(column), *tie_breakers)


def sort_keys(df: DataFrame, columns: Sequence[str], descending: bool = False) -> DataFrame:
    return df.orderBy(*columns, ascending=not descending)


def take_top(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """The first ``n`` rows of a total order; each task keeps only its own best ``n``."""
    return df.orderBy(*order).limit(n)


def union_positional(*frames: DataFrame) -> DataFrame:
    """Bag union by position."""
    return reduce(DataFrame.union, frames)
