"""Connected components by joins: no list of links ever meets in one task or at the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import cut_lineage


def rooted(links: DataFrame, rounds: int = 50) -> DataFrame:
    """Stored rows ``a`` and ``b``: of every node but the roots, the smallest node it can reach over the links (``a``, ``b``).

    Large-star and small-star steps in turn (Kiveris et al. 2014): every node hands its larger neighbours, then its
    smaller ones, to the smallest node around it, until nothing moves. A node with very many links is spread: the smallest
    neighbour is an aggregate, and the join back on a hot node is split by adaptive execution. Each round is stored. A large
    step gives a row per link at most, so repeated rows are dropped once a round, after the small step.
    Null ends, loops and repeated links are ignored. The result joins the same nodes as the links and may stand for them.
    """

    def mark(edges: DataFrame):
        return edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()

    edges = cut_lineage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b"))
    was = mark(edges)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = cut_lineage(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = cut_lineage(small.filter("a > b").distinct())
        now = mark(edges)
        if now == was:
            return edges
        was = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """``node`` and ``root`` (the smallest node it can reach) for every node of the links (``a``, ``b``); see ``rooted``."""
    edges = rooted(links, rounds)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
