"""Connected components by alternating large-star and small-star.

Large-star joins each node's larger neighbours to the least node of its neighbourhood, small-star does so with the
smaller neighbours and the node itself. Both keep what is connected and never add edges; when neither changes anything,
every component is a star around its least node.

A star's centre may have any number of edges: least neighbours are found by sums before the shuffle, and the edges are
joined to them without being grouped, so that adaptive execution can split a centre's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.llm.common import Scratch


def _joined_to_least(edges: DataFrame) -> DataFrame:
    """For edges (u, v): (u, v, m) with the least node m of u and its neighbours in the table."""
    least = edges.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
    return edges.join(least, "u")


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    out = _joined_to_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Edges must lead from the larger node u to the smaller v."""
    met = _joined_to_least(edges)
    out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(met.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) for the nodes of the undirected edges (a, b) but those that are their component's least node."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    now, state = scratch.store(down, "edges"), None
    while True:
        after = scratch.store(small_star(large_star(now)), "edges")
        scratch.free(now)
        now = after
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        state = seen
