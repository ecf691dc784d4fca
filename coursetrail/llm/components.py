"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursetrail.session import stored


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node it reaches.

    Rounds of large-star and small-star. Each round is written to the durable folder, which
    cuts the lineage. A hub's neighbours are never gathered: its smallest neighbour comes from a
    partial aggregate, and the join that hands it out may split a hub's rows.
    Null ends and links of a node with itself are left out; no links give no rows.
    """
    edges = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    mark = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("b").alias("root"), F.col("a").alias("node")).union(
        edges.select("b", F.col("b")).distinct()).select("node", "root")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    to_least = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to_least.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
