"""Connected components of any number of links, as DataFrames only.

Alternating large-star and small-star rounds: every node hands the smallest neighbour it knows to its larger
(then its smaller) neighbours. Minima are partial aggregates, so a node with millions of links costs one
row a task; the joins that follow have no aggregate on top, so that adaptive execution can split a hot node.
Each round ends in a checkpoint. Rounds stop when the links are stars round the smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusengine.llm._common import forget, settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v), u > v. Returns new edges of the same form and components."""
    flipped = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    near = edges.unionByName(flipped) if large else edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m") if large else F.col("m"))
    # Joined on ~u: else the aggregate's partitioning would serve the join too, in one stage, where a hot node can't be split.
    met = near.join(least, F.bitwise_not(near["u"]) == F.bitwise_not(least["k"]))
    if large:  # larger neighbours go to the smallest
        out = met.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # the smaller neighbours, and the node itself, go to the smallest
        out = met.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v")))
    return out.distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """links (a, b: long) -> (node, component): component is the smallest node reachable.

    Nodes without a link aren't in the result; loops and links with a null end are ignored; no links: no rows.
    """
    edges = settle(links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).distinct())

    def sign(df: DataFrame) -> tuple:
        """How many links there are and two sums of 64-bit hashes of them: equal for equal sets."""
        hashed = [F.sum(F.xxhash64(*pair).cast("decimal(38,0)")) for pair in (("u", "v"), ("v", "u"))]
        return tuple(df.agg(F.count("*"), *hashed).first())

    seen = sign(edges)
    while True:
        new = settle(_star(_star(edges, large=True), large=False))
        forget(edges)
        edges, now = new, sign(new)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
