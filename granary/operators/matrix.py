"""Feature-by-sample matrices in long form: feature, sample, value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.sequence import lineage_prefixes


def roll_up(df: DataFrame, lineage: str, sample: str, value: str, sep: str = ";") -> DataFrame:
    """level, feature, sample, value: sums for every prefix of an array lineage. Rows are summed by whole lineage first, then fanned out by level."""
    base = df.groupBy(lineage, sample).agg(F.sum(value).alias("_v"))
    each = base.select(sample, "_v", F.explode(lineage_prefixes(F.col(lineage), sep)).alias("_p"))
    return each.groupBy(F.col("_p.level").alias("level"), F.col("_p.name").alias("feature"), sample).agg(F.sum("_v").alias("value"))


def fan_out(df: DataFrame, column: str, pattern: str, share: bool = False, weight: str = "weight") -> DataFrame:
    """A row for each distinct non-empty term of a separated list; share=True splits the weight 1 evenly."""
    terms = F.array_distinct(F.filter(F.split(column, pattern), lambda x: x != ""))
    w = 1.0 / F.size("_t") if share else F.lit(1.0)
    return df.withColumn("_t", terms).withColumn(weight, w).withColumn(column, F.explode("_t")).drop("_t")


def normalize(df: DataFrame, sample: str = "sample", value: str = "value", scale: float = 1.0) -> DataFrame:
    """Share of the sample's total; 0 where the total is 0."""
    total = F.sum(value).over(W.partitionBy(sample))
    return df.withColumn(value, F.when(total == 0, 0.0).otherwise(F.col(value) * scale / total))


def wide(df: DataFrame, feature: str, sample: str, value: str, samples: list, failed: list | None = None) -> DataFrame:
    """A column for each listed sample, 0 where absent, null for failed ones, and total."""
    out = df.groupBy(feature).pivot(sample, samples).agg(F.sum(value)).fillna(0)
    out = out.withColumn("total", sum((F.col(f"`{s}`") for s in samples), F.lit(0)))
    for s in failed or []:
        out = out.withColumn(str(s), F.lit(None).cast("double"))
    return out


def long(df: DataFrame, feature: str, sample: str = "sample", value: str = "value") -> DataFrame:
    """Unpivot a wide matrix."""
    return df.unpivot([feature], [c for c in df.columns if c != feature], sample, value)


def modules(abundance: DataFrame, members: DataFrame, least: float = 0.5) -> DataFrame:
    """module, sample, completeness, score: share of a module's features present, mean abundance over present ones; modules under ``least`` are left out.

    abundance: feature, sample, value; members: module, feature.
    """
    size = members.groupBy("module").agg(F.countDistinct("feature").alias("_n"))
    hit = members.distinct().join(abundance.where("value > 0"), "feature").groupBy("module", "sample").agg(F.countDistinct("feature").alias("_k"), F.sum("value").alias("_s"))
    out = hit.join(size, "module").withColumn("completeness", F.col("_k") / F.col("_n"))
    return out.where(F.col("completeness") >= least).select("module", "sample", "completeness", (F.col("_s") / F.col("_k")).alias("score"))


def roll_up_terms(df: DataFrame, terms: str, sample: str, value: str, and_sep: str = ",", or_sep: str = "|", level_sep: str = ";") -> DataFrame:
    """level (from 0), term, sample, value of features with several terms: each of those joined by AND gets the whole value, those joined by OR share it evenly.

    A term's prefixes are its levels. Values are summed by term list first, so the fan-out is over distinct lists.
    """
    base = df.groupBy(terms, sample).agg(F.sum(value).alias("_v"))
    every = F.array_distinct(F.filter(F.split(terms, f"\\Q{and_sep}\\E"), lambda x: x != ""))
    each = base.select(sample, "_v", F.explode(every).alias("_a")).withColumn("_o", F.array_distinct(F.filter(F.split("_a", f"\\Q{or_sep}\\E"), lambda x: x != "")))
    each = each.select(sample, (F.col("_v") / F.size("_o")).alias("_v"), F.explode("_o").alias("_t")).groupBy(sample, "_t").agg(F.sum("_v").alias("_v"))
    parts = F.split("_t", f"\\Q{level_sep}\\E")
    levels = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct((i - 1).alias("level"), F.array_join(F.slice(parts, 1, i), level_sep).alias("term")))
    return each.select(sample, "_v", F.explode(levels).alias("_l")).groupBy("_l.level", "_l.term", sample).agg(F.sum("_v").alias(value))


def module_reactions(abundance: DataFrame, members: DataFrame, least: float = 0.5, redundancy: int = 5) -> DataFrame:
    """module, sample, completeness, score: a module is a list of reactions, a reaction is present if one of its features is.

    Completeness is the share of reactions present, the score the mean over present reactions of their features' summed abundance; features of more than
    ``redundancy`` modules are too common to tell and left out, as are modules under ``least``. abundance: feature, sample, value; members: module, reaction, feature.
    """
    m = members.distinct()
    common = m.groupBy("feature").agg(F.countDistinct("module").alias("_k")).where(F.col("_k") > redundancy)
    m = m.join(common, "feature", "left_anti")
    size = m.groupBy("module").agg(F.countDistinct("reaction").alias("_n"))
    hit = m.join(abundance.where("value > 0"), "feature").groupBy("module", "reaction", "sample").agg(F.sum("value").alias("_s"))
    out = hit.groupBy("module", "sample").agg(F.count("*").alias("_k"), F.avg("_s").alias("score")).join(size, "module").withColumn("completeness", F.col("_k") / F.col("_n"))
    return out.where(F.col("completeness") >= least).select("module", "sample", "completeness", "score")


def profile(df: DataFrame, group: str, sample: str, value: str, members: DataFrame, least: int = 1) -> DataFrame:
    """Mean over all members of a group (absent: 0) for each sample; groups of under ``least`` members are dropped. members: group, feature."""
    size = members.groupBy(group).agg(F.countDistinct("feature").alias("_n")).where(F.col("_n") >= least)
    return df.groupBy(group, sample).agg(F.sum(value).alias("_s")).join(size, group).select(group, sample, (F.col("_s") / F.col("_n")).alias("value"))


def background(df: DataFrame, category: str, sample: str, value: str) -> DataFrame:
    """For each sample the mean over categories of their positive sums."""
    return df.groupBy(category, sample).agg(F.sum(value).alias("_s")).where("_s > 0").groupBy(sample).agg(F.avg("_s").alias("value"))


def rows_of(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return df.join(keys.select(on).distinct(), on, "left_semi")


def anti_occurrence(df: DataFrame, feature: str, sample: str, present: Column) -> DataFrame:
    """a, b, ratio: of the samples that hold either feature of a pair, the share that holds one only.

    Both-counts come from samples' own features and the rest from totals, so pairs that never meet are left out (their ratio is 1).
    """
    p = df.where(present).select(F.col(feature).alias("f"), F.col(sample).alias("s")).distinct()
    total = p.groupBy("f").agg(F.count("*").alias("n"))
    both = p.alias("x").join(p.alias("y"), (F.col("x.s") == F.col("y.s")) & (F.col("x.f") < F.col("y.f"))).groupBy(F.col("x.f").alias("a"), F.col("y.f").alias("b")).agg(F.count("*").alias("both"))
    out = both.join(total.select(F.col("f").alias("a"), F.col("n").alias("na")), "a").join(total.select(F.col("f").alias("b"), F.col("n").alias("nb")), "b")
    single = F.col("na") + F.col("nb") - 2 * F.col("both")
    return out.select("a", "b", (single / (single + F.col("both"))).alias("ratio"))
