"""Connected components of a graph given as edges, by alternating star steps.

In each round every node points its neighbours to the smallest one it knows, first the
larger neighbours and then the smaller ones. Chains shorten by halves, so the number of
rounds grows with the logarithm of the longest chain. Minima are aggregated before they
are joined, so a node with very many neighbours is one aggregated row, and adaptive
execution splits its side of the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridebase.llm.tables import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node moves to the least of the node and its neighbours."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below move to the least of them. Edges run from larger ``a`` to smaller ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node that is not the least of its component.

    ``edges`` has columns ``a`` and ``b`` of one type; direction, repetition, self-loops and
    rows with a NULL do not matter. Each round is stored, so a lost executor costs one round.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = cut_lineage(edges, "edges"), None
    while True:
        count = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if count == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, edges = count, cut_lineage(_small_star(_large_star(edges)), "edges")
