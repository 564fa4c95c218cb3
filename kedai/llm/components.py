"""Connected components of a link table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kedai.llm.common import store


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node has one root and no root is a node."""
    ends = edges.select(
        F.inline(
            F.array(
                F.struct(F.col("node").alias("end"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                F.struct(F.col("root").alias("end"), F.lit(0).alias("up"), F.lit(1).alias("down")),
            )
        )
    )
    loose = ends.groupBy("end").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return loose.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node with the smallest node around it."""
    both = edges.select("node", "root").unionByName(
        edges.select(F.col("root").alias("node"), F.col("node").alias("root"))
    )
    least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
    return (
        both.join(least, "node")
        .where("root > node")
        .select(F.col("root").alias("node"), F.col("least").alias("root"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect every smaller neighbour of a node, and the node, with the smallest of them."""
    least = edges.groupBy("node").agg(F.min("root").alias("least"))
    moved = edges.join(least, "node").where("root <> least").select(
        F.col("root").alias("node"), F.col("least").alias("root")
    )
    return moved.unionByName(least.select("node", F.col("least").alias("root"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """The smallest reachable node of every node: node, root.

    ``links`` has the columns ``a`` and ``b`` in any direction, with repetitions and loops allowed.
    Nodes without a link to another node are not returned. The number of rounds grows with the
    logarithm of the longest path; each round writes its links to the shared folder. Nodes with very
    many links are no single group: minima are combined before the shuffle, joins may be split.
    """
    edges = store(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .distinct(),
        "links",
    )
    while not _is_forest_of_stars(edges):
        edges = store(_small_star(_large_star(edges)), "links")
    return edges
