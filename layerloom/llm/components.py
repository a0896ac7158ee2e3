"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import stage


def _least(pairs: DataFrame) -> DataFrame:
    """Per node ``u`` the smallest node among itself and its neighbours ``v``."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for the nodes of ``edges`` (``a``, ``b``).

    Large-star and small-star steps in turn: neighbours are hung under the smallest one they know,
    until every node hangs under the smallest of its component. The minima are combined before they
    move and joined back, so a node with very many neighbours is never gathered. Every round is
    written, which keeps the plan short and survives lost executors.
    """
    tree = stage(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        both = tree.unionAll(tree.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u != v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("v", "m").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        tree = stage(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        # Unchanged edges end the loop: their number and the sum of their hashes.
        now = tree.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return tree.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                tree.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        mark = now
