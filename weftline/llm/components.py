"""Connected components of a table of links, by rounds of hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.workspace import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node in ``links``.

    Each round gives a node the smallest label of its neighbours and then the label of that label,
    so chains shorten by powers of two.  Rounds are written to the workspace; only the count of
    changed labels reaches the driver.  Minima combine before the shuffle, so a node with very many
    links is no bottleneck.  Null ends and links of a node to itself add nothing.
    """
    ends = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "links")
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("component"))
    labels = materialize(labels.withColumnRenamed("a", "node"), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("near")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("near").alias("near"))
        )
        hooked = labels.join(near, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("hooked")
        )
        hooked = materialize(hooked, "hooked")
        jump = hooked.select(F.col("node").alias("hooked"), F.col("hooked").alias("further"))
        jumped = hooked.join(jump, "hooked", "left").select(
            "node", "old", F.least("hooked", F.coalesce("further", "hooked")).alias("component")
        )
        jumped = materialize(jumped, "labels")
        labels = jumped.select("node", "component")
        if jumped.where("old <> component").isEmpty():
            return labels
