"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, settle


def stars(edges: DataFrame) -> bool:
    """Every larger end has one link, and no smaller end is a larger end."""
    ends = edges.select("a", F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    ends = ends.groupBy("a").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.agg(F.max((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0))).first()[0] is not True


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``links`` (a, b).

    A round hangs every node's larger neighbours, then its smaller ones, under
    its smallest neighbour; it is two aggregates and joins on the node, written
    to the shared folder.  Rounds stop when the links are stars, after about
    log n of them; links that already are take none.  Self-links are ignored,
    nulls must not occur.
    """
    edges = settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    while not stars(edges):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        done, edges = edges, settle(small.where("a <> b").distinct(), "links")
        discard(done)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())


def stars_of(rooted: DataFrame) -> DataFrame:
    """The result of ``components`` as links again, to add others to it."""
    return rooted.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
