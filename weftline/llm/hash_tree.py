"""Placing rows in shards by descending a weighted hash tree: region, rack, shard.

At each level every child draws ``-ln(u) / weight``, with u a hash of (row key, child name), and
the least draw wins: a child gets its share of the weight, and a change of weights below one node
moves rows only between that node's children, or into the node whose weight grew.  Only native
expressions are used; the draws are plain arithmetic on md5 digits, so any SQL engine repeats them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: region name -> rack name -> shard number -> weight
Tree = Mapping[str, Mapping[str, Mapping[int, float]]]

SLOT_BITS = 12  # 4096 slot ranges a shard; the table of their sizes has 4096 x shards rows


def shard_tree(shards: int, base: int = 8, racks: int = 2, width: int = 2) -> Tree:
    """The tree of a shard count: ``base`` shards fill racks and regions, later ones stand alone.

    A later shard is a region of its own, so that it takes rows from all others and hands no row
    to a neighbour: going from n to n + 1 shards moves rows only into the new one.
    """
    tree: dict[str, dict[str, dict[int, float]]] = {}
    for shard in range(min(shards, base)):
        rack = shard // width
        region = tree.setdefault(f"region{rack // racks}", {})
        region.setdefault(f"rack{rack}", {})[shard] = 1.0
    for shard in range(base, shards):
        tree[f"region-of-{shard}"] = {f"rack-of-{shard}": {shard: 1.0}}
    return tree


def _weight(node: Mapping | float) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, Mapping) else float(node)


def _draw(key: Column, name: str, weight: float) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{name}"))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(weight)


def _descend(key: Column, node: Mapping, path: str) -> Column:
    below = {
        str(name): _descend(key, child, f"{path}/{name}") if isinstance(child, Mapping) else F.lit(name)
        for name, child in node.items()
    }
    if len(below) == 1:
        return next(iter(below.values()))
    draws = [_draw(key, f"{path}/{n}", _weight(node[c])) for n, c in zip(below, node, strict=True)]
    least = F.least(*draws)
    chosen = None
    for draw, child in zip(draws, below.values(), strict=True):
        chosen = F.when(draw == least, child) if chosen is None else chosen.when(draw == least, child)
    return chosen


def place(key: Column, tree: Tree) -> Column:
    """The shard number that ``tree`` gives ``key`` (a null key is the empty string)."""
    for region in tree.values():
        for rack in region.values():
            if not rack or min(rack.values()) <= 0:
                raise ValueError("every rack needs shards, and every shard a positive weight")
    return _descend(F.coalesce(key.cast("string"), F.lit("")), tree, "").cast("int")


def assign(df: DataFrame, key: str, tree: Tree, grown: Tree | None = None) -> DataFrame:
    """Add ``shard``, ``slot`` and (NULL without ``grown``) ``grown_shard``, the place in that tree.

    The slot numbers the rows of a shard from 0 without gaps.  A shard is far too large for one
    window, so its rows are spread over 4096 ranges by hash: sizes of ranges are counted with
    map-side combining, summed up per shard, and rows are numbered inside their range only.  The
    table of sizes is broadcast; it has 4096 rows a shard whatever the input.  Rows with the same
    key share a range, in any order among equals.  Columns of ``df`` named like the new ones are
    replaced; null keys are placed as the empty string; an empty table gives an empty result.
    """
    names = ("shard", "slot", "grown_shard")
    df = df.drop(*names)
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    digits = F.substring(F.md5(F.concat(text, F.lit(":slot"))), 1, SLOT_BITS // 4)
    placed = df.withColumns(
        {
            "shard": place(F.col(key), tree),
            "grown_shard": place(F.col(key), grown) if grown else F.lit(None).cast("int"),
            "__range": F.conv(digits, 16, 10).cast("int"),
        }
    )
    sizes = placed.groupBy("shard", "__range").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(
        F.col("shard").alias("__shard"),
        F.col("__range").alias("__at"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"),
    )
    inside = Window.partitionBy("shard", "__range").orderBy(key)
    return (
        placed.join(
            F.broadcast(first),
            (F.col("shard") == F.col("__shard")) & (F.col("__range") == F.col("__at")),
        )
        .withColumn("slot", F.col("__first") + F.row_number().over(inside) - 1)
        .drop("__shard", "__at", "__first", "__range")
    )


def place_sql(key: str, tree: Tree) -> str:
    """The same placement as SQL text (DuckDB), to check :func:`place` against."""

    def draw(name: str, weight: float) -> str:
        digits = f"('0x' || substr(md5(coalesce({key}::VARCHAR, '') || ':{name}'), 1, 13))::BIGINT"
        return f"(-ln(({digits}::DOUBLE + 0.5) / {1 << 52}::DOUBLE) / {weight}::DOUBLE)"

    def descend(node: Mapping, path: str) -> str:
        below = {n: descend(c, f"{path}/{n}") if isinstance(c, Mapping) else str(n) for n, c in node.items()}
        if len(below) == 1:
            return next(iter(below.values()))
        draws = {n: draw(f"{path}/{n}", _weight(node[n])) for n in below}
        least = f"least({', '.join(draws.values())})"
        return "CASE " + " ".join(f"WHEN {draws[n]} = {least} THEN {below[n]}" for n in below) + " END"

    return descend(tree, "")
