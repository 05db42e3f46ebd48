"""Alignment hits: filters, mate merge, best hits and function abundance.

Hits have query, subject, pident, aln_len, evalue, bitscore and, where used, qs, qe. Ties are always broken by evalue, then subject, so
results do not depend on input order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def passes(aln_len: Column, subject_len: Column, query_len: Column, pident: Column, required: float) -> Column:
    """At least 0.1 of the subject, 0.7 of the query, and 0.985 of the required identity."""
    return (aln_len >= 0.1 * subject_len) & (aln_len >= 0.7 * query_len) & (pident >= 0.985 * required)


def accept(hits: DataFrame, evalue: float, bits: float, aln_len: float, pident: float) -> DataFrame:
    return hits.where((F.col("evalue") <= evalue) & (F.col("bitscore") >= bits) & (F.col("aln_len") >= aln_len) & (F.col("pident") >= pident))


def by_thresholds(hits: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Every hit once for each threshold row (max_evalue, min_id) that it meets; thresholds is a short parameter table."""
    return hits.join(F.broadcast(thresholds), (F.col("evalue") <= F.col("max_evalue")) & (F.col("pident") >= F.col("min_id")))


def _order() -> list[Column]:
    return [F.desc("bitscore"), F.asc("evalue"), F.asc("subject")]


def best_hit(hits: DataFrame, by: list[str], order: list[Column] | None = None) -> DataFrame:
    """The first row of each group in a total order."""
    return hits.withColumn("_n", F.row_number().over(W.partitionBy(*by).orderBy(*(order or _order())))).where("_n = 1").drop("_n")


def drop_ambiguous(hits: DataFrame, by: str, category: str, score: str) -> DataFrame:
    """Best row of each group; groups whose best score occurs in several categories are dropped."""
    top = hits.withColumn("_r", F.rank().over(W.partitionBy(by).orderBy(F.desc(score)))).where("_r = 1")
    return top.groupBy(by).agg(F.min(category).alias(category), F.max(category).alias("_hi"), F.max(score).alias(score)).where(F.col(category) == F.col("_hi")).drop("_hi")


def merge_mates(a: DataFrame, b: DataFrame) -> DataFrame:
    """Hits of both mates on one subject: union length less overlap, mean identity, bitscore scaled by the overlap, least evalue."""
    first = [best_hit(x, ["query", "subject"], [F.desc("bitscore"), F.asc("evalue"), F.asc("qs"), F.asc("qe")]) for x in (a, b)]
    x, y = first[0].alias("x"), first[1].alias("y")
    both = x.join(y, (F.col("x.query") == F.col("y.query")) & (F.col("x.subject") == F.col("y.subject")))
    overlap = F.greatest(F.lit(0), F.least("x.qe", "y.qe") - F.greatest("x.qs", "y.qs") + 1)
    total = F.col("x.aln_len") + F.col("y.aln_len")
    return both.select(
        F.col("x.query").alias("query"), F.col("x.subject").alias("subject"), ((F.col("x.pident") + F.col("y.pident")) / 2).alias("pident"),
        (total - overlap).alias("aln_len"), F.least("x.evalue", "y.evalue").alias("evalue"),
        ((F.col("x.bitscore") + F.col("y.bitscore")) * (total - overlap) / total).alias("bitscore"),
    )


def fold_best(hits: DataFrame, by: str, near: float = 5.0) -> DataFrame:
    """Ordered fold: the best row is replaced by a later one that is clearly better in one of identity, length or bits while close in the others.

    Rows come in the order bits, evalue, subject. A row replaces the best if (identity within ``near`` below, length at least 0.97 of it and bits above 1.03 of
    it), or (identity higher, length above 0.92 of it, bits above 0.9 of it), or (length above 1.15 of it, identity within near, bits above 0.9).
    """
    row = "struct(-bitscore as o, evalue, subject, pident, aln_len, bitscore)"
    better = (
        f"(x.pident >= a.pident - {near} and x.aln_len >= 0.97 * a.aln_len and x.bitscore > 1.03 * a.bitscore) or (x.pident > a.pident and x.aln_len > 0.92 * a.aln_len and x.bitscore > 0.9 * a.bitscore) "
        f"or (x.aln_len > 1.15 * a.aln_len and x.pident >= a.pident - {near} and x.bitscore > 0.9 * a.bitscore)"
    )
    seen = hits.groupBy(by).agg(F.expr(f"array_sort(collect_list({row}))").alias("_h"))
    best = seen.select(by, F.expr(f"aggregate(slice(_h, 2, size(_h)), _h[0], (a, x) -> if({better}, x, a))").alias("_b"))
    return best.select(by, "_b.subject", "_b.pident", "_b.aln_len", "_b.evalue", "_b.bitscore")


def function_abundance(hits: DataFrame, annotation: DataFrame, merged: Column, subject_len: str = "subject_len") -> DataFrame:
    """norm, kingdom, category, value: counts (2 for a merged pair, else 1) and length-normalised counts; a hit's full score goes to each of its categories.

    annotation: subject, kingdom, categories (separated by , or ;), subject_len.
    """
    j = hits.join(annotation, "subject").withColumn("_w", F.when(merged, 2.0).otherwise(1.0))
    j = j.withColumn("category", F.explode(F.array_distinct(F.filter(F.split("categories", "[,;]"), lambda x: x != ""))))
    sums = j.groupBy("kingdom", "category").agg(F.sum("_w").alias("cnt"), F.sum(F.col("_w") * F.col("aln_len") / F.col(subject_len)).alias("GLN"))
    return sums.unpivot(["kingdom", "category"], ["cnt", "GLN"], "norm", "value")


def calibrate_cutoffs(scores: DataFrame, step: int = 10) -> DataFrame:
    """marker, cutoff, precision, recall: the cut-off with the highest F1 (the larger one of a tie), in steps from the least score.

    scores: marker, score, is_true. True and false counts above each cut-off come from one cumulative pass over score steps, not from a join.
    """
    low = F.min("score").over(W.partitionBy("marker"))
    s = scores.withColumn("cutoff", F.floor(low) + step * F.floor((F.col("score") - F.floor(low)) / step))
    n = s.groupBy("marker", "cutoff").agg(F.count_if("is_true").alias("t"), F.count_if(~F.col("is_true")).alias("f"))
    w = W.partitionBy("marker").orderBy(F.desc("cutoff")).rowsBetween(W.unboundedPreceding, 0)
    n = n.withColumn("tp", F.sum("t").over(w)).withColumn("fp", F.sum("f").over(w)).withColumn("all", F.sum("t").over(W.partitionBy("marker")))
    p, r = F.col("tp") / (F.col("tp") + F.col("fp")), F.col("tp") / F.col("all")
    n = n.where("all > 0").withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("tp") > 0, 2.0 * F.col("tp") / (F.col("tp") + F.col("fp") + F.col("all"))).otherwise(0.0)
    return best_hit(n.withColumn("f1", f1), ["marker"], [F.desc("f1"), F.desc("cutoff")]).select("marker", "cutoff", "precision", "recall")
