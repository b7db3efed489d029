"""Connected components of a graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cargolake.llm.base import written


def _hang(pairs: DataFrame, keep: str) -> DataFrame:
    """Hang neighbours of a node (``u``) on the smallest of them and itself."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(least, "u").where(keep)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked with over any number of ``links`` (a, b).

    Only nodes with a link to another node are listed. Every round the links of
    a node are hung on its smallest neighbour; the rounds grow with the
    logarithm of the number of nodes. A round is a written table, a node with
    many links is split by the join, and nothing but two sums reaches the driver.
    """
    edges = written(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hang(both, "v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        hung = _hang(large, "v < u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(hung.select("u", F.col("m").alias("v")))
        edges = written(small.where("u != v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
