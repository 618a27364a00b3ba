"""Connected components of an edge table by label propagation with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.session import cut


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable from each node of ``edges`` (``a, b``).

    Each round takes the smallest label among the neighbours and then the label of that label, so a path of n nodes
    needs about log n rounds. Labels are checkpointed in the shared folder after each round. Minima are combined
    map-side; a hub moves one row per task. No edges give no rows.
    """
    both = cut(edges.select("a", "b").where("a <> b").union(edges.select("b", "a").where("a <> b")).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("c"))
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("jumped"))
        moved = cut(lower.join(jump, "c", "left").select("node", "old", F.least("c", F.coalesce("jumped", "c")).alias("component")))
        labels = moved.select("node", "component")
        if moved.where("old <> component").isEmpty():
            return labels
