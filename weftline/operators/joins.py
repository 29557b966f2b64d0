"""Joins.

Any key may hold a large share of either side's rows.  Inner joins rely on AQE, which splits an
oversized partition of both sides.  It cannot split the side that an outer join keeps apart, nor a
side that doesn't come straight from its shuffle; there, keys that a sketch finds hot are dealt over
cells (see ``weftline.operators.skew``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.layout import build_bytes
from weftline.operators.skew import BROADCAST_LIMIT_BYTES, deal, sketch

HOWS = ("inner", "left", "right", "outer")
SALTED_HOWS = ("inner", "left", "left_anti")


def join_using(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner join on equal names; the key appears once."""
    return left.join(right, key)


def join_aliased(
    left: DataFrame, right: DataFrame, key: str, aliases: tuple[str, str]
) -> DataFrame:
    """Inner join that keeps both keys, addressed as ``alias.key``."""
    a, b = aliases
    return left.alias(a).join(right.alias(b), F.col(f"{a}.{key}") == F.col(f"{b}.{key}"))


def join_data(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
    rows_per_part: int = 1_000_000,
) -> DataFrame:
    """Join on two key names: inner, left, right or outer.  Column names must not overlap.

    For outer joins the keys of both sides are measured by a sketch.  Keys with more than
    ``rows_per_part`` rows on a side are split there and copied on the other; all others are joined
    as they are, in the same join, so each side is read once.  A row that was copied has a partner
    in some cell, since its key is hot on the other side; its copies without one are dropped.
    """
    if how not in HOWS:
        raise ValueError(f"unknown join {how!r}; known: {', '.join(HOWS)}")
    same = left[left_key] == right[right_key]
    dealt = deal(left, right, left_key, right_key, rows_per_part) if how != "inner" else None
    if dealt is None or not dealt.needed:
        return left.join(right, same, how)
    names = ("__cell0", "__cell1", "__copied")
    sides = [
        dealt.side(df, F.col(key), number).withColumnsRenamed({c: f"{c}_{number}" for c in names})
        for number, (df, key) in enumerate(((left, left_key), (right, right_key)))
    ]
    for cell in names[:2]:
        same &= F.col(f"{cell}_0") == F.col(f"{cell}_1")
    mine, theirs = F.col("__copied_0"), F.col("__copied_1")
    lone_copy = (mine.isNull() & theirs) | (theirs.isNull() & mine)
    joined = sides[0].join(sides[1], same, how).where(~F.coalesce(lone_copy, F.lit(False)))
    return joined.select(*[F.col(f"`{c}`") for c in (*left.columns, *right.columns)])


def join_broadcast(
    big: DataFrame,
    small: DataFrame,
    key: str | Sequence[str],
    how: str = "inner",
    limit_bytes: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Broadcast ``small`` if what it takes as a hashed relation is within the limit, else a shuffled join.

    The measurement is one aggregate over ``small``.  Above the limit Spark picks the join,
    with both sides partitioned by the key.
    """
    if build_bytes(small) <= limit_bytes:
        return big.join(F.broadcast(small), key, how)
    return big.join(small, key, how)


def join_shuffle_hash(
    big: DataFrame, small: DataFrame, key: str | Sequence[str], partition_bytes: int = 64 * 1024 * 1024
) -> DataFrame:
    """Partition both sides by the key and build hash tables from ``small``.

    A hash table can't spill.  So the build side is measured first: if its mean share of a partition
    or that of its hottest key is above ``partition_bytes``, both sides are merged instead.
    """
    size = build_bytes(small)
    keys = [key] if isinstance(key, str) else list(key)
    heat = sketch(small, F.xxhash64(*[F.col(k) for k in keys]))
    partitions = int(small.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hottest = max(heat.hot.values(), default=0) / max(1, heat.rows)
    fits = size * max(hottest, 1 / partitions) <= partition_bytes
    return big.join(small.hint("shuffle_hash" if fits else "merge"), key)


def join_sort_merge(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Partition and sort both sides by the key, then merge; spills at any size."""
    return left.join(right.hint("merge"), key)


def join_star_left(fact: DataFrame, *dimensions: tuple[DataFrame, Column]) -> DataFrame:
    """Left joins of a fact with dimensions in the order given, smallest first.

    Facts without a partner keep NULL.  The order does not change the rows, only how wide
    they are when they meet the larger dimensions.
    """
    joined = fact
    for dimension, condition in dimensions:
        joined = joined.join(dimension, condition, "left")
    return joined


def join_roles(
    fact: DataFrame, dimension: DataFrame, key: str, roles: dict[str, Column | str]
) -> DataFrame:
    """Join one dimension once per role: ``roles`` maps an alias to the fact's key for it."""
    joined = fact
    for alias, fact_key in roles.items():
        left = F.col(fact_key) if isinstance(fact_key, str) else fact_key
        joined = joined.join(dimension.alias(alias), left == F.col(f"{alias}.{key}"))
    return joined


def join_salted(
    big: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    salts: int | None = None,
    rows_per_salt: int = 1_000_000,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join whose hot keys are spread over salts: inner, left or left_anti, ``big`` on the left.

    ``big`` rows get a salt from a hash of ``spread_by`` (all columns by default), which a
    retried task repeats; ``small`` rows are repeated once per salt.  With ``salts`` every key
    is spread that often.  Without it a sketch of the keys, which shuffles none of them, names the
    hot ones, and only these are spread, each in proportion to its rows.  NULL keys match nothing
    and are spread alike.  The repeated rows are always shuffled and merged: the optimizer takes
    them for as few as ``small`` has, and would send them whole to the driver and every task.

    AQE splits hot keys only where both sides of the join come straight from their shuffles;
    use this form where one side is an aggregate on the same key.
    """
    if how not in SALTED_HOWS:
        raise ValueError(f"a salted join is one of {', '.join(SALTED_HOWS)}")
    if salts is not None:
        spread = F.xxhash64(*[F.col(c) for c in (spread_by or big.columns)])
        fanned = big.withColumn("__part", F.pmod(spread, F.lit(salts)).cast("int"))
        copies = small.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    else:
        dealt = deal(big, small, key, key, rows_per_salt, both=False)
        if not dealt.needed:
            return big.join(small, key, how)
        unused = ("__cell1", "__copied")
        fanned = dealt.side(big, F.col(key), 0, spread_by).drop(*unused)
        copies = dealt.side(small, F.col(key), 1).drop(*unused)
        fanned, copies = (df.withColumnRenamed("__cell0", "__part") for df in (fanned, copies))
    return fanned.join(copies.hint("merge"), [key, "__part"], how).drop("__part")
