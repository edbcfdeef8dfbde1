"""Connected components of a table of links, by shrinking labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a``, ``b``): the smallest node reachable.

    Each round a node takes the smallest label among its neighbours, then the label of that label.
    Rounds are cut off from each other by a stored table; the driver sees only whether labels changed.
    A node with very many links is one row on the label side, and minima are combined before shuffles.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")))
    while True:
        seen = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("near"))
        lower = labels.join(seen, labels.node == seen.a).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("lower")
        )
        target = labels.select(F.col("node").alias("_target"), F.col("component").alias("_jump"))
        moved = stored(
            lower.join(target, F.col("lower") == F.col("_target"), "left").select(
                "node", "old", F.least("lower", F.coalesce("_jump", "lower")).alias("component")
            )
        )
        done = moved.where("old <> component").isEmpty()
        labels = moved.select("node", "component")
        if done:
            return labels
