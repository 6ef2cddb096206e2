"""Connected components by alternating star contraction, every round stored in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelspend.llm.shared import discard, stage


def checksum(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, whatever their order."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("low", "high"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root), stored: the smallest node that each node of ``edges`` (a, b) is connected to, itself left out.

    A round sends every node's larger neighbours to the least of its neighbourhood, then every
    node and its smaller neighbours to the least of them; nodes of many neighbours
    are joined, never gathered.  Rounds grow with the logarithm of the longest way.
    """
    edges = edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).filter("low < high")
    edges = stage(edges.distinct(), "edges")
    before = checksum(edges)
    while before[0]:
        both = edges.unionAll(edges.select("high", "low")).toDF("node", "near")
        least = both.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("root"))
        large = both.filter("near > node").join(least, "node").select(F.col("root").alias("low"), F.col("near").alias("high"))
        large = stage(large.distinct(), "edges")
        least = large.groupBy("high").agg(F.min("low").alias("root"))
        small = large.join(least, "high").select(F.col("root").alias("low"), F.col("low").alias("high"))
        after = stage(small.unionAll(least.select("root", "high")).filter("low < high").distinct(), "edges")
        discard(edges, large)
        edges, now = after, checksum(after)
        if now == before:
            break
        before = now
    stars = edges.select(F.col("high").alias("node"), F.col("low").alias("root"))
    stars.stage_path = edges.stage_path
    return stars
