"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from publicspend.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, one of the nodes of its component, for links ``a``, ``b``.

    Each round every node takes its least neighbour's least neighbour, and the links are drawn
    anew between what was taken; those that became loops go. So the links melt away in a few
    rounds, and each is touched little more than once. All of it is joins and sums on stored
    tables. Links may repeat or loop.
    """
    apart = links.where("a <> b")
    edges = stored(apart.select("a", "b").union(apart.select("b", "a")).distinct(), "links")
    labels = None
    while True:
        near = edges.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("up"))
        above = near.select(F.col("node").alias("at"), F.col("up").alias("root"))
        roots = stored(
            near.join(above, F.col("up") == F.col("at")).select("node", "root"), "roots"
        )
        if labels is None:
            labels = roots.withColumnRenamed("root", "label")
        else:
            moved = roots.withColumnRenamed("node", "of")
            labels = labels.join(moved, F.col("label") == F.col("of"), "left").select(
                "node", F.coalesce("root", "label").alias("label")
            )
        left = roots.select(F.col("node").alias("a"), F.col("root").alias("c"))
        right = roots.select(F.col("node").alias("b"), F.col("root").alias("d"))
        drawn = edges.join(left, "a").join(right, "b").where("c <> d")
        edges = stored(drawn.select(F.col("c").alias("a"), F.col("d").alias("b")).distinct(), "links")
        if edges.isEmpty():
            return stored(labels, "labels")
