"""Connected components of a graph given by its edges, by joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelab.sources.scratch import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.

    Rounds of the large-star and small-star steps: every node links its larger neighbours, then
    its smaller ones, to the smallest node it knows. The graph stays as small as its edges, a node with
    many neighbours is handled by joins, and a chain of n nodes takes about log n rounds. Each
    round is written to the shared folder; the loop ends when it changes nothing. Nulls are no nodes.
    """
    pairs = edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).where("a > b")
    pairs = stage(pairs.distinct(), "edges")
    known = _signature(pairs)
    while known[0]:
        pairs = stage(_small_star(_large_star(pairs)), "edges")
        now = _signature(pairs)
        if now == known:
            break
        known = now
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _signature(pairs: DataFrame) -> tuple:
    row = pairs.agg(
        F.count(F.lit(1)),
        F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)),
        F.coalesce(F.sum(F.hash("a", "b").cast("long")), F.lit(0)),
    ).first()
    return tuple(row)


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of itself and its neighbours."""
    near = pairs.select(F.col("a").alias("n"), F.col("b").alias("m")).union(
        pairs.select(F.col("b"), F.col("a"))
    )
    least = near.groupBy("n").agg(F.min("m").alias("low"))
    least = least.select("n", F.least("n", "low").alias("low"))
    linked = near.where("m > n").join(least, "n").select(F.col("m").alias("a"), F.col("low").alias("b"))
    return linked.distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the smallest of them."""
    least = pairs.groupBy("a").agg(F.min("b").alias("low"))
    others = pairs.join(least, "a").where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.union(least.select("a", F.col("low").alias("b"))).distinct()
