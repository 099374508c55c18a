"""Connected components of links between rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chuvisco.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, component)``, the component being its smallest node, for every node of ``links (a, b)``.

    Alternates two steps until nothing changes: every node's larger neighbours are linked to the smallest node it
    knows, then so are its smaller ones. Each step is a partial aggregate and a join, so a node with very many links is
    no bottleneck, and chains halve in length.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = stored(small.where("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select("b", "b").distinct()
            )
        before = now
