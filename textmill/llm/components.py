"""Connected components of a graph given as an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stash


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    moved = both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the least of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    to = least.select(F.col("u").alias("c"), "m")
    moved = edges.join(to, F.col("u") == F.col("c")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """(node, root) for every node with an edge; root is the component's least node.

    ``edges`` has long columns u and v; direction, repeats and loops do not matter. Large
    and small star operations alternate until the edges are stars round the least node
    (logarithmic rounds). Every round is aggregates and equi-joins over the edge table; a
    node's neighbours are never gathered in one row and nothing but a checksum comes to the
    driver. An empty edge table gives an empty result.
    """
    now = stash(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label
    )
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = tuple(mark)
        after = stash(_small_star(_large_star(now)), label)
        discard(now)
        now = after
