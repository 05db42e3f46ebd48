"""Length statistics of sets of sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def _by_length(df: DataFrame, group: str, length: str, descending: bool) -> DataFrame:
    """Distinct lengths of a group with running totals; equal lengths are one row, so ties need no order."""
    n = df.groupBy(group, F.col(length).cast("long").alias("len")).agg(F.count("*").alias("c"))
    n = n.withColumn("w", F.col("len") * F.col("c"))
    w = W.partitionBy(group).orderBy(F.desc("len") if descending else F.asc("len"))
    run = w.rowsBetween(W.unboundedPreceding, 0)
    n = n.withColumn("run", F.sum("w").over(run)).withColumn("seen", F.sum("c").over(run))
    return n.withColumn("total", F.sum("w").over(W.partitionBy(group))).withColumn("count", F.sum("c").over(W.partitionBy(group)))


def n_descending(df: DataFrame, group: str, length: str, share: float = 0.5, genome: int | None = None) -> DataFrame:
    """group, n, l: the first length, longest first, whose running total passes int(share * total), and its place; genome replaces the total."""
    s = _by_length(df, group, length, True)
    goal = F.floor(F.lit(share) * (F.lit(genome) if genome else F.col("total")))
    hit = s.where(F.col("run") > goal).groupBy(group).agg(F.max("len").alias("n"), F.max(F.struct("len", "run", "seen", "w", "c")).alias("_h"), F.max(goal).alias("_goal"))
    before = F.col("_h.run") - F.col("_h.w")
    place = F.col("_h.seen") - F.col("_h.c") + F.floor((F.col("_goal") - before) / F.greatest(F.col("_h.len"), F.lit(1))) + 1
    return hit.select(group, "n", place.cast("long").alias("l"))


def n_ascending(df: DataFrame, group: str, length: str, share: float = 0.5) -> DataFrame:
    """group, n: the first length, shortest first, whose running total reaches int(share * total)."""
    s = _by_length(df, group, length, False)
    return s.where(F.col("run") >= F.floor(F.lit(share) * F.col("total"))).groupBy(group).agg(F.min("len").alias("n"))


def length_statistics(df: DataFrame, group: str, length: str) -> DataFrame:
    """group, sequences, total, longest, shortest, mean, median (upper), over_1k, over_10k."""
    x = F.col(length).cast("long")
    base = df.groupBy(group).agg(F.count("*").alias("sequences"), F.sum(x).alias("total"), F.max(x).alias("longest"), F.min(x).alias("shortest"), F.round(F.avg(x), 4).alias("mean"), F.count_if(x > 1000).alias("over_1k"), F.count_if(x > 10000).alias("over_10k"))
    s = _by_length(df, group, length, False)
    mid = s.where(F.col("seen") > F.floor(F.col("count") / 2)).groupBy(group).agg(F.min("len").alias("median"))
    return base.join(mid, group)


def length_tier(df: DataFrame, group: str, length: str, tiers: tuple[int, ...] = (10000, 5000, 2000, 1000), least: int = 2, top: int = 5) -> DataFrame:
    """The group's longest members of the first tier that more than ``least`` exceed, at most ``top``; ties to the first column's smaller value."""
    key = next(c for c in df.columns if c not in (group, length))
    n = df.groupBy(group).agg(*[F.count_if(F.col(length) > t).alias(f"_t{t}") for t in tiers])
    tier = F.lit(None).cast("int")
    for t in reversed(tiers):
        tier = F.when(F.col(f"_t{t}") > least, t).otherwise(tier)
    j = df.join(n.select(group, tier.alias("tier")), group).where(F.col(length) > F.col("tier"))
    w = W.partitionBy(group).orderBy(F.desc(length), key)
    return j.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top)


def numbered(df: DataFrame, value: Column, ties: list[str], name: str) -> DataFrame:
    """df with name: places from 1 in order of an integer value, then of ties, over the whole table.

    Counts by value give each value its first place; only they are ordered in one task, and rows are numbered within a value.
    """
    t = df.withColumn("_v", value.cast("long"))
    n = t.groupBy("_v").agg(F.count("*").alias("_c"))
    n = n.select("_v", F.coalesce(F.sum("_c").over(W.orderBy("_v").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.row_number().over(W.partitionBy("_v").orderBy(*ties))
    return t.withColumn("_own", own).join(n, "_v").withColumn(name, F.col("_before") + F.col("_own")).drop("_v", "_own", "_before")
