"""Connected components of a table of links, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.tables import kept


def connected_components(links: DataFrame, one: str, other: str) -> DataFrame:
    """(node, component) for every node of the links; the component is its smallest node.

    Each round hooks every node and its label below the smallest label next to it, then
    follows labels of labels, so long chains shrink by halves. Sums over a hot node's links
    are partly formed before the shuffle. Rounds are written to the shared folder.

    No links give an empty table; repeated links and links of a node to itself change nothing.
    """
    both = links.select(F.col(one).alias("node"), F.col(other).alias("next"))
    both = both.filter("node is not null and next is not null and node <> next")
    edges = kept(both.unionByName(both.select(F.col("next").alias("node"), F.col("node").alias("next"))).distinct())
    labels = kept(edges.groupBy("node").agg(F.least(F.min("next"), F.col("node")).alias("component")))
    while True:
        near = edges.join(labels.withColumnRenamed("node", "next"), "next")
        least = near.groupBy("node").agg(F.min("component").alias("near"))
        hooked = labels.join(least, "node").select(
            "node", F.col("component").alias("old"), F.least("near", "component").alias("component")
        )
        # the old label's own label falls too: whole trees move, not single nodes
        roots = hooked.groupBy(F.col("old").alias("root")).agg(F.min("component").alias("lower"))
        jumped = hooked.join(roots, F.col("component") == F.col("root"), "left").select(
            "node", "old", F.least("component", F.coalesce("lower", "component")).alias("component")
        )
        stored = kept(jumped)
        labels = stored.select("node", "component")
        if stored.filter("component <> old").isEmpty():
            return labels
