"""Connected components of an edge table, by alternating large and small stars.

A large star hangs every larger neighbour of a node on the node's smallest neighbour; a small star
does so with the smaller ones. Both are a minimum per node and a join, so nothing of a component
ever meets in one task; each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _hang(edges: DataFrame, least: DataFrame) -> DataFrame:
    least = stage(least, "stars")
    return edges.join(least, "a")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 30))).first())


def components(edges: DataFrame) -> DataFrame:
    """``edges``: a, b. Returns node and root, the smallest node it is linked to, for every node of
    an edge to another node. Edges with a null end, loops and repeats change nothing."""
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = stage(pairs, "edges")
    state = _state(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = _hang(both, least).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stage(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _hang(large, least).select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        pairs = stage(small.select("e.*").where("a <> b").distinct(), "small-star")
        before, state = state, _state(pairs)
        if state == before:
            break
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
