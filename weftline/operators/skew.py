"""Hot keys: found by a mergeable sketch in one pass, and dealt over cells of a join or grouping.

Every task feeds its keys to a counter sketch of fixed size; the sketches are merged, so no key is
shuffled.  A sketch may overrate a key and names no key that does not occur.  What it says only
decides how rows are dealt, so results never depend on its estimates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 256 * 1024 * 1024
SHARE = 1 / 1024  # of all rows; a key with fewer doesn't unbalance a shuffle
COUNTERS = 1 << 14  # the sketch's error is 3.5 / 2**15 of the rows, far below half the share

#: Types that the sketch takes as they are.
SKETCHED = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
    T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType, T.DecimalType,
)


@dataclass(frozen=True)
class Heat:
    """Hot values of a key with their estimated rows, and the rows whose key is NULL."""

    rows: int
    nulls: int
    hot: dict


def sketch(df: DataFrame, key: Column, share: float = SHARE) -> Heat:
    """The values that at least ``share`` of the rows have, by one aggregate without a shuffle of rows.

    At most ``2 / share`` values reach the driver; those with fewer rows than ``share`` are left out
    by their estimate, which is never below the true count.
    """
    if not 4 * 3.5 / (2 * COUNTERS) <= share <= 1:
        raise ValueError("the share must be far above the sketch's error")
    wanted = math.ceil(2 / share) + 1
    found = df.select(key.alias("key")).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("key").isNull()).alias("nulls"),
        F.expr(f"approx_top_k(key, {wanted}, {COUNTERS})").alias("top"),
    )
    row = found.first()
    hot = {t["item"]: t["count"] for t in row.top or () if t["item"] is not None}
    return Heat(row.rows, row.nulls, {k: n for k, n in hot.items() if n >= share * row.rows})


def heavy_hitters(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """``key`` and ``n``: the values that at least ``share`` of the rows have, counted exactly.

    The sketch names the candidates, a bounded number; only their rows are counted.  NULL is a value
    like others.  An empty table has none.
    """
    candidates = sketch(df, F.col(key), share)
    kept = [(k,) for k in candidates.hot]
    if candidates.nulls >= share * max(1, candidates.rows):
        kept.append((None,))
    table = df.sparkSession.createDataFrame(kept, T.StructType([T.StructField("__hot", df.schema[key].dataType)]))
    counted = df.join(F.broadcast(table), F.col(key).eqNullSafe(F.col("__hot")), "left_semi")
    return counted.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= share * candidates.rows)


def _plain(kind: T.DataType) -> bool:
    """Whether values can be hashed: nothing in them is a map or variant."""
    return not any(word in kind.simpleString() for word in ("map<", "variant"))


def row_salt(df: DataFrame, spread_by: Sequence[str] | None = None) -> Column:
    """A number for each row that a retried task repeats; equal rows of different tasks differ."""
    names = spread_by or [f.name for f in df.schema.fields if _plain(f.dataType)]
    return F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in names])


@dataclass(frozen=True)
class Deal:
    """How the rows of two sides are dealt over cells (mine, theirs) of their key.

    A key that is hot on one side is split there into as many parts as its rows need, and the other
    side's rows of that key are copied into each; so a pair of rows meets in just one cell.
    """

    table: DataFrame | None
    split: tuple[bool, bool]
    nulls: tuple[bool, bool]

    @property
    def needed(self) -> bool:
        return any(self.split) or any(self.nulls)

    def side(self, df: DataFrame, key: Column, number: int, spread_by: Sequence[str] | None = None) -> DataFrame:
        """Add ``__cell0``, ``__cell1`` and ``__copied`` to side 0 or 1.

        A copied row's key is hot on the other side, so it is known to have a partner there.  Rows
        without a key have none anywhere; each is a cell of its own.
        """
        salt = row_salt(df, spread_by)
        own, other = F.lit(1), F.lit(1)
        if self.table is not None:
            names = ("__hot", "__parts0", "__parts1")
            df = df.join(F.broadcast(self.table), key == F.col("__hot"), "left")
            own = F.coalesce(f"__parts{number}", F.lit(1))
            other = F.coalesce(f"__parts{1 - number}", F.lit(1))
        else:
            names = ()
        mine = F.when(key.isNull(), salt).otherwise(F.pmod(salt, own.cast("long")))
        copies = F.lit(0).cast("long")
        if self.split[1 - number]:
            copies = F.explode(F.sequence(copies, other.cast("long") - 1))
        return df.withColumns(
            {
                f"__cell{number}": mine,
                f"__cell{1 - number}": copies,
                "__copied": other > 1,
            }
        ).drop(*names)


def deal(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, rows_per_part: int, both: bool = True
) -> Deal:
    """Measure both sides' keys (only the left one's without ``both``) and decide how to deal them.

    Integers of any width are compared as such; sides whose keys have other types than each other,
    or types that the sketch does not take, are not dealt.
    """
    kinds = [left.schema[left_key].dataType, right.schema[right_key].dataType]
    integers = all(isinstance(k, T.IntegralType) for k in kinds)
    if not integers and (kinds[0] != kinds[1] or not isinstance(kinds[0], SKETCHED)):
        return Deal(None, (False, False), (False, False))
    kind = T.LongType() if integers else kinds[0]
    sides = [(left, left_key), (right, right_key)][: 2 if both else 1]
    heats = [sketch(df, F.col(name).cast(kind)) for df, name in sides]
    parts = [
        {k: math.ceil(n / rows_per_part) for k, n in heat.hot.items() if n > rows_per_part} for heat in heats
    ]
    parts += [{}] * (2 - len(parts))
    nulls = [heat.nulls > max(rows_per_part, SHARE * heat.rows) for heat in heats] + [False]
    rows = [(k, parts[0].get(k, 1), parts[1].get(k, 1)) for k in {**parts[0], **parts[1]}]
    schema = T.StructType().add("__hot", kind).add("__parts0", T.IntegerType()).add("__parts1", T.IntegerType())
    table = left.sparkSession.createDataFrame(rows, schema) if rows else None
    return Deal(table, (bool(parts[0]), bool(parts[1])), (nulls[0], nulls[1]))
