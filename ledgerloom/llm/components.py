"""Connected components by alternating large and small stars, all links staying distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import staged


def connected(edges: DataFrame) -> DataFrame:
    """edges (u, v: long) to (node, root), root being the smallest node of its component; nodes without a link to another are left out.

    Each round sums by node before it shuffles (min is combined on the map side); rounds are written to the shared
    folder, and as many as the logarithm of a component's size are needed. What a hub is joined with is written first,
    so that both sides are shuffled only for the join and the engine can split a hub's rows over tasks. Null ends and
    loops are left out.
    """
    now = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "links-low")
        large = staged(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links-large")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "links-least")
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "links")
