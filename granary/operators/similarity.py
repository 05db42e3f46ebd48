"""Similarity clusters of sequences: k-mer sets, min-hash bands for candidates, exact k-mer containment to decide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def similar_groups(seqs: DataFrame, name: str, seq: str, share: float = 0.8, k: int = 8, hashes: int = 8) -> DataFrame:
    """name, representative: the longest sequence (then the smallest name) among those with a common min-hash that hold ``share`` of this one's k-mers; itself if none does.

    Candidates come from ``hashes`` min-hashes, each a group by its value in which the longest member leads, so this approximates: a pair that shares no
    min-hash, or is no leader's, is not found. Every assignment is verified on whole k-mer sets; no pairs are made inside a group.
    """
    cut = seqs.where(F.length(seq) >= k).select(F.col(name).alias("name"), F.length(seq).alias("len"), F.split(seq, "").alias("_c"))
    sets = cut.select("name", "len", F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("_c") - k), lambda i: F.xxhash64(F.array_join(F.slice("_c", i + 1, F.lit(k)), "")))).alias("set"))
    marks = F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)), lambda s: F.array_min(F.transform("set", lambda h: F.xxhash64(h, s))))
    rows = sets.select("name", "len", F.posexplode(marks).alias("band", "mark"))
    lead = rows.groupBy("band", "mark").agg(F.min(F.struct((-F.col("len")).alias("l"), F.col("name").alias("n")))["n"].alias("leader"))
    pairs = rows.join(lead, ["band", "mark"]).where("leader != name").select("name", "leader").distinct()
    both = pairs.join(sets.select("name", F.col("set").alias("own")), "name").join(sets.select(F.col("name").alias("leader"), F.col("len").alias("l_len"), F.col("set").alias("other")), "leader")
    ok = both.where(F.size(F.array_intersect("own", "other")) >= share * F.size("own"))
    best = ok.groupBy("name").agg(F.min(F.struct((-F.col("l_len")).alias("l"), F.col("leader").alias("n")))["n"].alias("representative"))
    return seqs.select(F.col(name).alias("name")).join(best, "name", "left").select(F.col("name").alias(name), F.coalesce("representative", "name").alias("representative"))
