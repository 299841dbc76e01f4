"""Connected components of an edge table: smallest labels spread along edges and are shortened by pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of the undirected edges (a, b); the label is the component's smallest node.

    Each round takes the least label among a node's neighbours, then replaces a label by its own label, so the
    number of rounds grows with the logarithm of the longest path at most. Sums before the shuffle keep hubs small;
    the joins carry no grouping on their keys, so that adaptive execution can split a hub's rows.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct()
    both = stored(both.filter("a <> b"), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        lower = stored(lower, "labels")
        short = lower.select(F.col("node").alias("label"), F.col("label").alias("shorter"))
        nearer = lower.join(short, "label").select("node", "old", F.col("shorter").alias("label"))
        nearer = stored(nearer, "labels")
        labels = nearer.select("node", "label")
        if nearer.filter("label <> old").isEmpty():
            return labels
