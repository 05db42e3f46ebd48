"""Lowest common ancestors, votes and congruence over ranked lineages (arrays with ``?`` for unknown)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Identities (percent) that a rank from the second to the species needs, and the tolerance below the best identity.
RANK_IDENTITY = (85.0, 88.0, 91.0, 93.0, 95.0, 97.0)
TOLERANCE = ((100.0, 0.1), (99.5, 0.25), (99.0, 0.5), (98.0, 1.0), (97.0, 1.25))


def vote(members: DataFrame, group: str, lineage: str, depth: int, fraction: float = 0.9) -> DataFrame:
    """group, level, name, votes, n: prefixes held by at least ceil(fraction * n) members, as deep as they go.

    Two prefixes cannot both reach more than half; at half or below a tie ends the lineage.
    """
    base = members.groupBy(group, lineage).agg(F.count("*").alias("_c"))
    base = base.withColumn("n", F.sum("_c").over(W.partitionBy(group)))
    each = base.select(group, "n", "_c", lineage, F.explode(F.sequence(F.lit(1), F.lit(depth))).alias("level")).where(F.expr(f"get({lineage}, level - 1) != '?'"))
    each = each.groupBy(group, "n", "level", F.array_join(F.slice(lineage, F.lit(1), F.col("level")), ";").alias("name")).agg(F.sum("_c").alias("votes"))
    won = each.where(F.col("votes") >= F.ceil(fraction * F.col("n"))).withColumn("_k", F.count("*").over(W.partitionBy(group, "level")))
    won = won.where("_k = 1").withColumn("_i", F.row_number().over(W.partitionBy(group).orderBy("level")))
    return won.where("level = _i").select(group, "level", "name", "votes", "n")


def lca(hits: DataFrame, query: str, lineage: str, pident: str, aln_len: str, fraction: float = 0.9, length_share: float = 0.85) -> DataFrame:
    """query, level, name: hits near the best identity and length vote, as deep as the best identity allows."""
    w = W.partitionBy(query)
    best = F.max(pident).over(w)
    slack = F.lit(1.5)
    for at, t in reversed(TOLERANCE):
        slack = F.when(F.col("_best") >= at, t).otherwise(slack)
    kept = hits.withColumn("_best", best).withColumn("_len", F.max(aln_len).over(w)).where((F.col(pident) >= F.col("_best") - slack) & (F.col(aln_len) >= length_share * F.col("_len")))
    deep = F.lit(1) + sum((F.when(F.col("_best") >= x, 1).otherwise(0) for x in RANK_IDENTITY), F.lit(0))
    limit = kept.groupBy(query).agg(F.max(deep).alias("_deep"))
    got = vote(kept, query, lineage, len(RANK_IDENTITY) + 1, fraction)
    return got.join(limit, query).where("level <= _deep").select(query, "level", "name")


def covered_lca(hits: DataFrame, query: str, lineage: str, pident: str, aln_len: str, query_len: str, fraction: float = 0.8, cover: float = 0.6, least: int = 50) -> DataFrame:
    """lca over the hits that cover enough of their query and are long enough, with a smaller share of votes."""
    return lca(hits.where((F.col(aln_len) >= cover * F.col(query_len)) & (F.col(aln_len) >= least)), query, lineage, pident, aln_len, fraction)


def deepest(won: DataFrame, group: str) -> DataFrame:
    return won.groupBy(group).agg(F.max("level").cast("int").alias("level"), F.max_by("name", "level").alias("name"))


def majority(members: DataFrame, group: str, rank: str, name: str, least: int = 100, share: float = 0.8) -> DataFrame:
    """group, rank, name: the most frequent name if it has at least ``least`` votes and more than ``share`` of them, else ``?``."""
    n = members.groupBy(group, rank, name).agg(F.count("*").alias("v"))
    top = n.groupBy(group, rank).agg(F.max(F.struct(F.col("v"), F.col(name).alias("name"))).alias("t"), F.sum("v").alias("n"))
    ok = (F.col("n") >= least) & (F.col("t.v") > share * F.col("n"))
    return top.select(group, rank, F.when(ok, F.col("t.name")).otherwise("?").alias("name"))


def congruence(members: DataFrame, group: str, lineage: str, depth: int) -> DataFrame:
    """group, score: over ranks, the leading name's share of known names, weighted by (depth - rank) and the rank's coverage."""
    each = members.select(group, F.posexplode(lineage).alias("rank", "name")).where(f"rank < {depth}")
    n = each.groupBy(group, "rank").agg(F.count("*").alias("all"))
    known = each.where("name != '?'").groupBy(group, "rank", "name").agg(F.count("*").alias("v")).groupBy(group, "rank").agg(F.max("v").alias("m"), F.sum("v").alias("s"))
    w = (depth - F.col("rank")) * F.col("s") / F.col("all")
    return known.join(n, [group, "rank"]).groupBy(group).agg((F.sum(w * F.col("m") / F.col("s")) / F.sum(w)).alias("score"))


def assign_by_votes(votes: DataFrame, group: str, target: str, least: int = 5, runner_up: float = 0.5, chimera: float = 0.6) -> DataFrame:
    """group, target, hits, chimeric: the target with most votes if over ``least`` and the next has at most runner_up of them; chimeric under ``chimera`` of all."""
    n = votes.groupBy(group, target).agg(F.count("*").alias("hits"))
    w = W.partitionBy(group).orderBy(F.desc("hits"), target)
    n = n.withColumn("_r", F.row_number().over(w)).withColumn("_next", F.coalesce(F.lead("hits").over(w), F.lit(0))).withColumn("_all", F.sum("hits").over(W.partitionBy(group)))
    return n.where((F.col("_r") == 1) & (F.col("hits") > least) & (F.col("_next") <= runner_up * F.col("hits"))).select(group, target, "hits", (F.col("hits") < chimera * F.col("_all")).alias("chimeric"))
