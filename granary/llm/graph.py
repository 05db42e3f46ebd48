"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, settle


def _sign(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, label (the smallest node of its component) for the nodes of edges (u, v: long); nodes without an edge are left out.

    Every step deals edges by node and keeps a minimum for each, so no task or driver holds a component; each round's edges
    are checkpointed in the shared folder, which cuts the lineage.
    """
    e = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
    sign = _sign(e)
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = checkpointed(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        e, before, sign = after, sign, _sign(after)
        settle(e.sparkSession)
        if sign == before:
            roots = e.select(F.col("v").alias("node")).distinct().withColumn("label", F.col("node"))
            return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
    raise RuntimeError("components did not settle")
