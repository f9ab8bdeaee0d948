"""Connected components of links between long ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return joined.filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component): every node with a link, and the smallest node it can reach.

    `links` has columns a and b. Every round halves the depth of the trees at least; each is cut from its
    lineage in the shared folder, so a lost executor costs one round.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = checkpointed(edges)
    while True:
        after = checkpointed(_small_star(_large_star(edges)))
        # Stars only: every node has one link, to a node that has none itself.
        if (after.count() == edges.count() and after.exceptAll(edges).isEmpty()):
            return after.select(F.col("a").alias("node"), F.col("b").alias("component"))
        edges = after
