"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablemargin.sources.tables import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect each node's larger neighbours to the smallest of the node and its neighbours (edges may repeat)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (both.join(least, "a").filter(F.col("b") > F.col("a"))
            .select(F.least("a", "least").alias("a"), "b").filter("a != b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    joined = down.join(least, "a")
    return (joined.select(F.col("least").alias("x"), F.col("b").alias("y"))
            .unionByName(least.select(F.col("least").alias("x"), F.col("a").alias("y")))
            .filter("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link (columns a, b); the root is the smallest node of its component."""
    roots = roots_of_others(links)
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def roots_of_others(links: DataFrame) -> DataFrame:
    """`components` without the roots' own rows: it reads what the last round wrote, with no shuffle after it.

    Each round is written before the next reads it. Rounds end when all edges form stars, which another round would not
    change; their number grows with the logarithm of the number of nodes. Self-links, repeated and reversed links do no
    harm, and no links give no rows.
    """
    edges = stage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a != b").distinct(),
                  "links")
    while not _stars(edges):
        edges = stage(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _stars(edges: DataFrame) -> bool:
    """Whether each node is either the smaller end of its edges, or the larger end of one."""
    ends = (edges.select(F.col("b").alias("node"), F.lit(1).alias("larger"), F.lit(0).alias("smaller"))
            .unionByName(edges.select(F.col("a").alias("node"), F.lit(0).alias("larger"), F.lit(1).alias("smaller"))))
    placed = ends.groupBy("node").agg(F.sum("larger").alias("larger"), F.max("smaller").alias("smaller"))
    return placed.filter("larger + smaller > 1").count() == 0
