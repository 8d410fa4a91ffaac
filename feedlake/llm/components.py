"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is a grouped minimum and a join on one node, so nothing is gathered by component: a node
with a third of all edges costs a partial aggregate and a skewed equi-join. The number of rounds
follows the logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import stored


def _digest(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
    return r[0], r[1]


def _star(pairs: DataFrame, upper: bool) -> DataFrame:
    """pairs(u, v): each u joins its neighbours (those above it, or all given and itself) to the smallest."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    joined = pairs.join(least, F.col("u") == F.col("w"))
    if upper:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("b"), F.col("m").alias("a"))
    else:
        out = joined.select(F.col("v").alias("b"), F.col("m").alias("a")).union(least.select(F.col("w").alias("b"), F.col("m").alias("a")))
    return out.where(F.col("a") < F.col("b")).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) in any order -> (node, component), the component being its smallest node; nodes
    without an edge to another node are left out."""
    now = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-0")
    last, k = _digest(now), 0
    while last[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = stored(_star(both, True), f"cc-{k}-large")
        now = stored(_star(large.select(F.col("b").alias("u"), F.col("a").alias("v")), False), f"cc-{k}-small")
        k, seen = k + 1, _digest(now)
        if seen == last:
            break
        last = seen
    least = now.groupBy("a").agg(F.lit(1)).select(F.col("a").alias("node"), F.col("a").alias("component"))
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(least)
