"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotcast.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b); root is the smallest node reachable.
    Each round is two partial aggregations with their joins and is written to shared storage; the
    rounds grow with the logarithm of the longest path. Self links and repeated links are harmless."""
    edges = written(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.where("m < u").select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        large = written(large)
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(root.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = written(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == tuple(now):
            break
        seen = tuple(now)
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
