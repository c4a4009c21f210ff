"""Connected components of an edge table, in a number of rounds that grows with the logarithm of the paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookflow.runtime import release, staged


def _least(edges: DataFrame) -> DataFrame:
    """(u, m): the least of each u and its neighbours v."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _stars(edges: DataFrame) -> DataFrame:
    """One round over (u, v) with u > v: all greater neighbours of a node move to the least one around it, then all lesser ones do."""
    around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = around.join(_least(around), "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = _least(large)
    lesser = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lesser.union(least.select("u", F.col("m").alias("v"))).distinct()


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).head())


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: list | None = None) -> DataFrame:
    """(node, component) for each node of edges (a, b: long); component is the least node that is reachable.

    Alternating large and small stars: every round hangs nodes onto the least node
    around them, so a path of n edges is done in about log2(n) rounds, whatever its
    order of ids. A hot node's neighbours are reduced by partial minima before a shuffle,
    and its rows of the join are split by Spark's skew join. Rounds are written to the shared
    folder and the ones before removed. `rounds`, if given, takes a line per round.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    nodes = staged(pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct(), "nodes")
    now = staged(pairs.where("u <> v").distinct(), "stars")
    seen = _print(now)
    while seen[0]:
        new = staged(_stars(now), "stars")
        release(now)
        now, before, seen = new, seen, _print(new)
        if rounds is not None:
            rounds.append(seen[0])
        if seen == before:
            break
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
