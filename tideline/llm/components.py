"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``links``, the component being
    its smallest node. Nodes are longs.

    Every round links each node's larger neighbours to its smallest one, then
    each node and its smaller neighbours to the smallest of them, until only
    stars are left: a logarithmic number of rounds for any shape. Nodes with
    very many links are pre-aggregated (a minimum per task) before a shuffle;
    nothing is gathered per node. Each round is written to the shared folder,
    so a lost executor repeats one round's tasks. Links to oneself are left
    out; an empty table has no components.
    """
    edges = (links.select(F.greatest(a, b).cast("bigint").alias("u"), F.least(a, b).cast("bigint").alias("v"))
             .where("u <> v").distinct())
    edges = cut(edges, "links")
    for _ in range(max_rounds):
        if _are_stars(edges):
            break
        # large star: a node's larger neighbours get its smallest neighbour (or itself)
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v"))
        # small star: a node's smaller neighbours and itself get the smallest of them
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(down.select("u", F.col("m").alias("v"))).distinct())
        edges = cut(small, "links")
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and none of its
    own if it is one: then the smaller neighbours are the components."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    nodes = ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.where("down + up > 1").isEmpty()
