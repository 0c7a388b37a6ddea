"""Connected components of a link table by alternating star contractions, in DataFrame rounds on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinloft.session import cut_lineage


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the least node of its neighbourhood."""
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them. Links run from the larger (a) to the smaller (b)."""
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every node of ``links(a, b)``; a component is named by its least node.

    Self links are ignored, repeated links count once. Each round is written to the shared folder; the driver sees
    only two totals a round. A table without links gives an empty table.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    mark = None
    for _ in range(rounds):
        edges = cut_lineage(_small_star(_large_star(edges)), "components")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
