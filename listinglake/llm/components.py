"""Connected components by alternating star contraction, as joins and group-bys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listinglake.operators.skew import hot_keys, spread_join
from listinglake.session import store

#: Neighbours of one node that a task meets; with more they are dealt to several.
HOT = 20_000


def _roots(pairs: DataFrame) -> DataFrame:
    """(u, root): the smallest of each ``u`` and its neighbours."""
    return pairs.groupBy("u").agg(F.min("v").alias("root")).select(
        "u", F.least("root", "u").alias("root")
    )


def _stars(edges: DataFrame) -> bool:
    """Every node is either a leaf of one centre or a centre."""
    leaf = edges.select(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre"))
    centre = edges.select(F.col("v").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("centre"))
    roles = leaf.union(centre).groupBy("node").agg(
        F.sum("leaf").alias("leaf"), F.max("centre").alias("centre")
    )
    return roles.where(F.col("leaf") + F.col("centre") > 1).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest id reachable, for every id that ``edges`` (a, b) names.

    Every round hangs each node's neighbours on the smallest one, large and small
    neighbours by turns, until the edges are stars around the smallest ids; rounds grow
    with the logarithm of the longest chain. Each round is a written table, so a lost
    executor costs one round.
    Null ids, loops and repeated edges are ignored; without edges there are no rows.
    """
    whole = edges["a"].isNotNull() & edges["b"].isNotNull() & (edges["a"] != edges["b"])
    now = store(
        edges.where(whole)
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    while not _stars(now):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hot = hot_keys(both, ["u"], rows=HOT)
        large = (
            spread_join(both, _roots(both), ["u"], "inner", hot, ["v"])
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("root").alias("v"))
        )
        roots = _roots(large)
        small = (
            spread_join(large, roots, ["u"], "inner", hot, ["v"])
            .where(F.col("v") != F.col("root"))
            .select(F.col("v").alias("u"), F.col("root").alias("v"))
            .union(roots.select("u", F.col("root").alias("v")))
            .distinct()
        )
        now = store(small, "edges")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(leaves.select("root", "root").distinct())
