"""Connected components of a link table, as shuffles only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webstats.llm.common import stored


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``links`` (a, b); the component is its smallest node.

    Alternating star contraction: larger neighbours are tied to the smallest
    node known, then each node's smaller neighbours to the least of them, until
    every link leads straight to the smallest node of its component.  Each round
    writes its table to the shared folder; the driver sees one row per round.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, name)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = (tied.where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        small = stored(small, name)
        # done when every node has one link and no linked-to node has a smaller neighbour
        state = small.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        old = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        edges = small
        if state == old:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
