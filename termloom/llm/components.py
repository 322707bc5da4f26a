"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import saved

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node in ``edges(a, b)``; the smallest node names it.

    Each round first hangs a node's larger neighbours on its smallest one, then
    all its smaller neighbours. Minima are combined before a shuffle, edges never
    grow in number, and only a checksum of each round comes to the driver.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = saved(
        edges.where("a <> b").select(high.alias("u"), low.alias("v")).dropDuplicates()
    )
    before = None
    for _ in range(ROUNDS):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").dropDuplicates()
        )
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").select(
            F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")
        )
        edges = saved(
            small.select("e.u", F.col("e.m").alias("v")).where("u <> v").dropDuplicates()
        )
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components are not final after {ROUNDS} rounds")
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).dropDuplicates()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)
