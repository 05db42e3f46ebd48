"""Report tables over samples and groups: rank matrices, depth tables, genome content, tree distances, consensus totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def rank_matrix(df: DataFrame, lineage: str, sample: str, value: str, sep: str = ";") -> DataFrame:
    """level, name, sample, value: abundances by every prefix of a lineage; summed by whole lineage before they fan out."""
    base = df.groupBy(lineage, sample).agg(F.sum(value).alias(value))
    parts = F.split(lineage, f"\\Q{sep}\\E")
    each = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(i.alias("level"), F.array_join(F.slice(parts, 1, i), sep).alias("name")))
    return base.select(sample, value, F.explode(each).alias("_l")).groupBy("_l.level", "_l.name", sample).agg(F.sum(value).alias(value))


def clades_of_rank(df: DataFrame, clade: str, letter: str) -> DataFrame:
    """Rows of a clade table whose last rank (``a__x|b__y``) is of one letter, with name, that rank without its mark."""
    return df.withColumn("name", F.regexp_extract(clade, rf"(?:^|\|){letter}__([^|]*)$", 1)).where(F.col(clade).rlike(rf"(?:^|\|){letter}__[^|]*$"))


def filled(df: DataFrame, feature: str, samples: list, sample: str, values: list[str]) -> DataFrame:
    """A wide matrix for each measure in one table: measure, feature and a column a sample, 0 where a feature is absent."""
    long = df.unpivot([feature, sample], values, "measure", "_v")
    return long.groupBy("measure", feature).pivot(sample, samples).agg(F.first("_v")).fillna(0)


def genome_content(genes: DataFrame, genomes: DataFrame, categories: list[str]) -> DataFrame:
    """A row a genome: group, star for the group's representative, quality, and the genes of each marker category; other genes by contig in ``rest``.

    genes: genome, contig, ordinal, gene, category (null: none); genomes: genome, group, compl, conta. The representative has the highest compl - 2 conta.
    """
    wide = genes.where(F.col("category").isin(*categories)).groupBy("genome").pivot("category", categories).agg(F.array_join(F.array_sort(F.collect_set(F.col("gene").cast("string"))), ","))
    other = genes.where(F.col("category").isNull() | ~F.col("category").isin(*categories)).groupBy("genome", "contig").agg(F.array_sort(F.collect_list(F.struct("ordinal", F.col("gene").cast("string").alias("gene")))).alias("_g"))
    other = other.groupBy("genome").agg(F.array_sort(F.collect_list(F.struct("contig", F.array_join(F.transform("_g", lambda x: x["gene"]), ",").alias("_t")))).alias("_c"))
    other = other.select("genome", F.array_join(F.transform("_c", lambda x: x["_t"]), "|").alias("rest"))
    best = W.partitionBy("group").orderBy(F.desc(F.col("compl") - 2 * F.col("conta")), "genome")
    g = genomes.withColumn("star", F.when(F.row_number().over(best) == 1, "*").otherwise(""))
    return g.join(wide, "genome", "left").join(other, "genome", "left")


def quantile_report(df: DataFrame, by: str, value: str, probabilities: tuple[float, ...]) -> DataFrame:
    """by, n and one column a quantile (linear between values)."""
    return df.groupBy(by).agg(F.count("*").alias("n"), *[F.percentile(value, p).alias(f"q{round(100 * p)}") for p in probabilities])


def largest(df: DataFrame, value: str, name: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.desc(value), name).limit(n)


def selection_summary(sites: DataFrame, gene: str, negative: str = "p_neg", positive: str = "p_pos", least: float = 0.9) -> DataFrame:
    """Sites under negative and positive selection above ``least``, and median and mean rates. sites: gene, p_neg, p_pos, dn, ds."""
    stats = [f(c).alias(f"{n}_{c}") for c in ("dn", "ds") for n, f in (("median", F.median), ("mean", lambda c: F.round(F.avg(c), 6)))]
    return sites.groupBy(gene).agg(F.count_if(F.col(negative) > least).alias("negative"), F.count_if(F.col(positive) > least).alias("positive"), *stats)


def duplicate_ratio(hits: DataFrame, lengths: DataFrame, least: float = 98.0) -> DataFrame:
    """One row: aligned length over contig length of the contigs with self hits above an identity. hits: contig, pident, aln_len; lengths: contig, length."""
    own = hits.where(F.col("pident") > least).groupBy("contig").agg(F.sum("aln_len").alias("covered"))
    return own.join(lengths, "contig").agg(F.round(F.sum("covered") / F.sum("length"), 6).alias("ratio"))


def distance_summary(pairs: DataFrame, by: list[str], distance: str, weight: str | None = None) -> DataFrame:
    """by, n, mean, mode (the smallest of the most frequent, to four digits) and standard deviation; with a weight, a weighted mean."""
    d = F.col(distance)
    mean = F.avg(d) if weight is None else F.sum(d * F.col(weight)) / F.sum(weight)
    top = pairs.groupBy(*by, F.round(d, 4).alias("_m")).agg(F.count("*").alias("_k"))
    top = top.groupBy(*by).agg(F.max(F.struct("_k", (-F.col("_m")).alias("_m")))["_m"].alias("_m"))
    out = pairs.groupBy(*by).agg(F.count("*").alias("n"), F.round(mean, 6).alias("mean"), F.round(F.stddev_samp(d), 6).alias("sd"))
    return out.join(top, by).select(*by, "n", "mean", (-F.col("_m")).alias("mode"), "sd")


def across_runs(df: DataFrame, marker: str, run: str, value: str, runs: list) -> DataFrame:
    """A marker a row, a run a column, and in how many runs it was found."""
    wide = df.groupBy(marker).pivot(run, runs).agg(F.max(value))
    return wide.withColumn("found", sum((F.col(f"`{r}`").isNotNull().cast("int") for r in runs), F.lit(0)))


def consensus_header(contig: Column, covered: Column, replaced: Column, conflicts: Column) -> Column:
    return F.format_string("%s COV=%d REPL=%d CONFL=%d", contig, covered, replaced, conflicts)


def header_number(header: Column, name: str) -> Column:
    """The number after NAME= in a consensus header; null without one."""
    return F.regexp_extract(header, rf"(?:^|[ ;]){name}=(\d+)", 1).try_cast("long")


def consensus_totals(headers: DataFrame, header: str) -> DataFrame:
    """One row: records, covered and replaced places over all headers."""
    return headers.agg(F.count("*").alias("records"), F.sum(header_number(F.col(header), "COV")).alias("covered"), F.sum(header_number(F.col(header), "REPL")).alias("replaced"))


def differences_as_variants(reference: DataFrame, consensus: DataFrame, chunk: int = 1000) -> DataFrame:
    """contig, pos (from 1), ref, alt where two sequences of a contig differ and neither letter is N. Sequences are walked by chunks."""
    j = reference.select("contig", F.col("seq").alias("r")).join(consensus.select("contig", F.col("seq").alias("c")), "contig")
    at = F.explode(F.sequence(F.lit(0), F.floor((F.greatest(F.length("r"), F.lit(1)) - 1) / chunk).cast("int"))).alias("k")
    parts = j.select("contig", "r", "c", at).select("contig", "k", F.split(F.substring("r", F.col("k") * chunk + 1, F.lit(chunk)), "").alias("r"), F.split(F.substring("c", F.col("k") * chunk + 1, F.lit(chunk)), "").alias("c"))
    each = parts.select("contig", "k", F.posexplode(F.arrays_zip("r", "c")).alias("i", "x"))
    ok = (F.col("x.r") != F.col("x.c")) & ~F.col("x.r").isin("N", "") & ~F.col("x.c").isin("N", "")
    return each.where(ok).select("contig", (F.col("k") * chunk + F.col("i") + 1).alias("pos"), F.col("x.r").alias("ref"), F.col("x.c").alias("alt"))


def hits_per_gene(hits: DataFrame, catalog: DataFrame, gene: str) -> DataFrame:
    """gene, hits: every gene of the catalog, 0 without a hit; hits on other genes are left out."""
    return catalog.select(gene).distinct().join(hits.groupBy(gene).agg(F.count("*").alias("hits")), gene, "left").fillna(0, ["hits"])


def of_size(df: DataFrame, group: str, least: int) -> DataFrame:
    """Rows of groups with at least so many members; sizes are joined, so that no group meets in one task."""
    big = df.groupBy(group).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    return df.join(big.select(group), group, "left_semi")


def good_genomes(quality: DataFrame, stats: DataFrame, genome: str, least: float = 80.0, most: float = 5.0) -> DataFrame:
    return stats.join(quality.where((F.col("compl") >= least) & (F.col("conta") <= most)), genome)


def first_reads(reads: DataFrame, by: str, priority: str, name: str, most: int) -> DataFrame:
    """At most so many reads a sample, merged ones (lower priority number) before others."""
    return reads.withColumn("_n", F.row_number().over(W.partitionBy(by).orderBy(priority, name))).where(F.col("_n") <= most).drop("_n")


def sorted_hits(hits: DataFrame, query: str, order: list[Column]) -> DataFrame:
    """Hits of a query together and in order; Spark spills what does not fit."""
    return hits.repartitionByRange(query).sortWithinPartitions(query, *order)


def hit_pieces(hits: DataFrame, query: str, pieces: int) -> DataFrame:
    """hits with piece: about equal parts that never cut a query, by a hash of it."""
    return hits.withColumn("piece", F.pmod(F.xxhash64(query), F.lit(pieces)).cast("int"))


def union_summaries(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """All tables under one header, their name in a column; a column that a table lacks is null there."""
    out = None
    for k, t in tables.items():
        t = t.withColumn(name, F.lit(k))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def frequency_list(df: DataFrame, lineage: str) -> DataFrame:
    """lineage, n, place: distinct lineages, the most frequent first, equal ones by name."""
    from .assembly import numbered

    return numbered(df.groupBy(lineage).agg(F.count("*").alias("n")), -F.col("n"), [lineage], "place").select(lineage, "n", "place")


# What mapper and duplicate logs print, by column.
LOG_PATTERNS = {
    "reads": r"(\d+) reads; of these", "paired": r"(\d+) \([\d.]+%\) were paired", "aligned_once": r"(\d+) \([\d.]+%\) aligned concordantly exactly 1 time",
    "aligned_more": r"(\d+) \([\d.]+%\) aligned concordantly >1 times", "overall": r"([\d.]+)% overall alignment rate", "duplicates": r"DUPLICATE TOTAL: (\d+)",
    "written": r"WRITTEN: (\d+)", "examined": r"EXAMINED: (\d+)",
}


def log_table(logs: DataFrame, name: str, text: str, patterns: dict[str, str] = LOG_PATTERNS) -> DataFrame:
    """A sample a row, a number a column: the first group of each pattern's first match over the sample's logs; null where no log has it."""
    found = [F.when(F.col(text).rlike(p), F.regexp_extract(text, p, 1)).try_cast("double").alias(c) for c, p in patterns.items()]
    return logs.select(name, *found).groupBy(name).agg(*[F.max(c).alias(c) for c in patterns])


def category_lines(members: DataFrame, category: str, sample: str, gene: str) -> DataFrame:
    """category, line: ``sample|gene`` of a category's genes, sorted and joined by tabs, for tree building."""
    one = F.concat(F.col(sample).cast("string"), F.lit("|"), F.col(gene).cast("string"))
    return members.groupBy(category).agg(F.array_join(F.array_sort(F.collect_set(one)), "\t").alias("line"))
