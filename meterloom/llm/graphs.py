"""Connected components of a table of links, by alternating stars, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import discard, stored


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (node, root): every linked node with the smallest node reachable from it.

    Large stars lead a node's larger neighbours to its smallest one, small stars the smaller ones; the number of links
    never grows, and the rounds needed grow with the logarithm of the longest chain. A hub's links are met row by row,
    never gathered.
    """
    pairs = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct()
    pairs = stored(pairs, "links")
    seen = None
    while True:
        both = pairs.select(F.col("u").alias("x"), F.col("v").alias("y")).union(pairs.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.least("x", F.min("y")).alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u")).union(least.select("v", F.col("m").alias("u")))
        before, pairs = pairs, stored(small.where("u < v").distinct(), "links")
        discard(before)
        state = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen = state
    node = pairs.select(F.col("v").alias("node"), F.col("u").alias("root"))
    return node.union(pairs.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
