"""Connected components of a link table, without gathering any neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.llm.common import stored


def _nearest(edges: DataFrame, node: str, other: str) -> DataFrame:
    return edges.groupBy(node).agg(F.min(other).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _nearest(both, "u", "v").select("u", F.least("m", "u").alias("m"))
    joined = both.join(least, "u").where(F.col("v") > F.col("u"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    least = _nearest(edges, "u", "v")
    joined = edges.join(least, "u")
    moved = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over (a, b) links of whole numbers.

    Alternating star operations: each round is a minimum per node with partial results
    and an equi-join, kept as a table. Ends when a round changes nothing, with every
    node linked to its smallest. Only linked nodes are returned.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("u") != F.col("v"))
    edges = stored(edges.distinct(), "links")
    mark = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(own)
