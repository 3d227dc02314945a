"""Connected components by alternating stars, with one written table per half round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editsieve.llm.common import settle


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) undirected, of type long -> (node, root): root is the smallest node reachable.

    The large star hangs the larger neighbours of each node on its smallest one, the small star does so with
    the smaller ones. Minima combine before the shuffle, so a node with any number of links is no hot group. A fixed
    point is a forest of stars. Nodes without a link do not appear.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = settle(edges, "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        hung = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = settle(hung.where("a <> b").distinct(), "large-star")
        low = edges.groupBy("a").agg(F.min("b").alias("low"))
        hung = edges.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        edges = settle(hung.where("a <> b").union(low.select("a", F.col("low").alias("b"))).distinct(), "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return members.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
