"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marea.session import materialized


MAX_BROADCAST = 500_000     # links up to which the smallest neighbours are broadcast


def _nearest(pairs: DataFrame, small: bool) -> DataFrame:
    """Each (node, other) with the smallest node of the whole neighbourhood. Only the minimum
    is grouped by node, which combines map-side; a hub's pairs are joined, which splits."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    return pairs.join(F.broadcast(least) if small else least, "node").withColumn("least", F.least("node", "least"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every linked node: the smallest node it reaches.

    Each round replaces a node's links by links to the smallest node known in its
    neighbourhood, first for its larger and then for its smaller neighbours, until
    every component is one star; that takes a number of rounds that is logarithmic in
    the longest chain. Every round is written to the shared folder, which cuts the
    lineage and tells whether the next one's joins are small enough to broadcast.
    """
    edges = materialized(links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other"))
                         .where(F.col("node") != F.col("other")))
    while True:
        few = 2 * edges.count() <= MAX_BROADCAST
        both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = _nearest(both, few).where(F.col("other") > F.col("node")) \
            .select(F.col("other").alias("node"), F.col("least").alias("other"))
        near = _nearest(large, few)
        small = near.select(F.col("other").alias("node"), F.col("least").alias("other")) \
            .unionByName(near.select("node", F.col("least").alias("other")))
        edges = materialized(small.where(F.col("node") != F.col("other")).distinct())
        ends = edges.select("node", F.lit(1).alias("up"), F.lit(0).alias("down")) \
            .unionByName(edges.select(F.col("other").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        between = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")) \
            .where("up > 1 or up > 0 and down > 0")
        if between.isEmpty():       # all are stars: one link up for each node, none for a centre
            break
    return edges.select("node", F.col("other").alias("component")) \
        .unionByName(edges.select(F.col("other").alias("node"), F.col("other").alias("component")).distinct())
