"""Connected components of a graph given as links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored

ROUNDS = 60


def _towards(edges: DataFrame) -> DataFrame:
    """(u, v, least): every edge with the smallest of u and its neighbours. Minima are partial sums
    before the shuffle, so a node with very many neighbours is no single task's work."""
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    return edges.join(least, "u").select("u", "v", F.least("u", "low").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all nodes in ``links`` (a, b); the root is the component's smallest node.

    Large stars hang the larger neighbours of each node on its smallest neighbour, small stars the
    smaller ones; trees flatten in a number of rounds that grows with the logarithm of their depth.
    Each round is stored. No links give no rows; loops and repeated links do no harm.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "links")
    mark = None
    for _ in range(ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        # each u now has smaller neighbours only
        small = _towards(large)
        pairs = small.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            small.select("u", F.col("least").alias("v"))
        )
        edges = stored(pairs.filter("u != v").distinct(), "stars")
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
