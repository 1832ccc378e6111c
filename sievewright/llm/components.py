"""Connected components of an edge table, without a driver or one task holding them.

Alternating star contraction: a round links every node to the least node among
its neighbours, first for the larger neighbours, then for the smaller ones.
Rounds end when the edges no longer change, about the logarithm of the longest
path. Minima come from partial aggregates, and each is written before it is
joined to the edges, so a hub is split like any skewed join key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import materialize


def _least(edges: DataFrame) -> DataFrame:
    return materialize(edges.groupBy("a").agg(F.min("b").alias("least")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour (or to itself)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select("a", F.least("a", "least").alias("least"))
    moved = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return materialize(moved.distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, are linked to the least of them. Edges point down."""
    least = _least(edges)
    moved = edges.join(least, "a").filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return materialize(moved.union(least.select("a", F.col("least").alias("b"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``edges`` (a, b) that are not their component's least; root is the least.

    Null and equal ends are ignored; an empty table gives an empty table.
    """
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, seen = materialize(down.distinct()), None
    while True:
        sign = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == seen or not sign[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = sign
        now = _small_star(_large_star(now))
