"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metrivane.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of ``edges`` (a, b): root is the smallest node that links reach.

    Alternates two star operations until nothing changes: every node hands its smallest neighbour to the
    larger ones, then to the smaller ones.  The number of rounds grows with the logarithm of the longest
    path.  Only the minimum of a neighbourhood is gathered, combined within map tasks; the neighbours
    themselves stay rows, and adaptive execution splits the rows of a hub.
    """
    down = _down(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).filter("u < v").distinct())
    before = None
    while True:
        both = down.unionByName(down.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        # large star: neighbours larger than v go to the minimum around v
        large = both.join(low, "v").filter("u > v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        large = large.unionByName(low.filter("m < v").select("v", F.col("m").alias("u"))).distinct()
        # small star: v and its smaller neighbours go to the smallest of them
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).filter("u < v")
        down = _down(small.unionByName(least.select("v", F.col("m").alias("u"))).distinct())
        state = down.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)")).alias("sum")).first()
        if state == before:
            break
        before = state
    return down.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        down.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )


def _down(edges: DataFrame) -> DataFrame:
    return stored(edges, "links")
