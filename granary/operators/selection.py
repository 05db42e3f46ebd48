"""Choices among hits, genomes and sequences: folds, representatives, replacements, alignment prefilters, rescue and declutter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_convincing(hits: DataFrame, by: str) -> DataFrame:
    """Ordered fold: within 5 points of the best identity, a row replaces the best if it is clearly longer, clearly more alike, or has over 0.8 of its bits.

    Rows come in the order bits (high first), evalue, subject.
    """
    row = "struct(-bitscore as o, evalue, subject, pident, aln_len, bitscore)"
    start = "named_struct('b', _h[0], 'ever', _h[0].pident)"
    better = (
        "x.pident > a.b.pident - 5 and ((x.pident >= a.b.pident * 0.97 and x.pident >= a.ever * 0.9 and x.aln_len >= a.b.aln_len * 1.15) "
        "or (x.pident >= a.b.pident * 1.03 and x.aln_len >= a.b.aln_len * 0.9) or x.bitscore > a.b.bitscore * 0.8)"
    )
    step = f"if({better}, named_struct('b', x, 'ever', greatest(a.ever, x.pident)), a)"
    seen = hits.groupBy(by).agg(F.expr(f"array_sort(collect_list({row}))").alias("_h"))
    best = seen.select(by, F.expr(f"aggregate(slice(_h, 2, size(_h)), {start}, (a, x) -> {step}, a -> a.b)").alias("_b"))
    return best.select(by, "_b.subject", "_b.pident", "_b.aln_len", "_b.bitscore")


def best_identity(hits: DataFrame, by: str, order: str) -> DataFrame:
    """by, pident, aln_len: what a group's hits are held against. A later hit counts if it is better in both, or 1.4 times as long at 0.9 of the identity."""
    better = "(x.pident > a.pident and x.aln_len > a.aln_len) or (x.aln_len > a.aln_len * 1.4 and x.pident > a.pident * 0.9)"
    seen = hits.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(order, "pident", "aln_len"))).alias("_h"))
    return seen.select(by, F.expr(f"aggregate(slice(_h, 2, size(_h)), _h[0], (a, x) -> if({better}, x, a))").alias("_b")).select(by, "_b.pident", "_b.aln_len")


def representative_genome(genes: DataFrame, genomes: DataFrame, group: str = "group", genome: str = "genome") -> DataFrame:
    """group, genome, score: mean occurrence of a genome's genes in its group (markers twice) over the group's observations, plus 0.01 (compl - 2 conta).

    genes: group, genome, gene, occ, is_marker; genomes: genome, compl, conta, observed (of the group). Ties go to the smaller name.
    """
    weight = F.sum(F.col("occ") * F.when(F.col("is_marker"), 2).otherwise(1)) / F.count("*")
    s = genes.groupBy(group, genome).agg(weight.alias("_w")).join(genomes, genome)
    s = s.withColumn("score", F.col("_w") / F.col("observed") + 0.01 * (F.col("compl") - 2 * F.col("conta")))
    best = s.groupBy(group).agg(F.min(F.struct((-F.col("score")).alias("s"), F.col(genome).alias("g"))).alias("_b"))
    return best.select(group, F.col("_b.g").alias(genome), F.round(-F.col("_b.s"), 6).alias("score"))


def replace_groups(groups: DataFrame, genomes: DataFrame, group: str = "group", genome: str = "genome") -> DataFrame:
    """group, genome, compl, conta: groups that pass, and for failing ones their best genome where its compl - 2 conta is higher than the group's own.

    groups: group, compl, conta, passes; genomes: group, genome, compl, conta, n50. The best genome has the highest (compl - 2 conta) * n50; genome is
    null where the group stays.
    """
    score = F.col("compl") - 2 * F.col("conta")
    best = genomes.groupBy(group).agg(F.max(F.struct((score * F.col("n50")).alias("s"), F.col(genome).alias("g"), "compl", "conta")).alias("_b"))
    j = groups.join(best, group, "left")
    better = ~F.col("passes") & (F.col("_b.compl") - 2 * F.col("_b.conta") > score)
    pick = lambda new, old: F.when(better, new).otherwise(old)
    return j.select(group, pick(F.col("_b.g"), F.lit(None)).alias(genome), pick(F.col("_b.compl"), F.col("compl")).alias("compl"), pick(F.col("_b.conta"), F.col("conta")).alias("conta"))


def _index_quantile(value: str, q: float) -> Column:
    """The element at int(n q) of the sorted values, the last one at most."""
    return F.expr(f"get(array_sort(collect_list({value})), least(cast(floor(count({value}) * {q}) as int), cast(count({value}) as int) - 1))")


def long_sequences(seqs: DataFrame, gene: str = "gene", species: str = "species", size: str = "size", length_share: float = 0.5, gene_share: float = 0.5) -> DataFrame:
    """Sequences of at least length_share of their gene's 0.9 quantile of length, in genes that keep at least gene_share of the 0.9 quantile of sequences a gene."""
    q = seqs.groupBy(gene).agg(_index_quantile(size, 0.9).alias("_q"))
    kept = seqs.join(q, gene).where(F.col(size) >= F.col("_q") * length_share)
    n = kept.groupBy(gene).agg(F.count("*").alias("_n"))
    many = n.agg(F.percentile("_n", 0.9).alias("_m"))
    return kept.join(n.where(F.col("_n") >= many.scalar() * gene_share), gene, "left_semi").select(species, gene, size)


def species_totals(seqs: DataFrame, species: str = "species", gene: str = "gene", size: str = "size") -> DataFrame:
    return seqs.groupBy(species).agg(F.countDistinct(gene).alias("genes"), F.sum(size).alias("letters"))


def full_sequences(counts: DataFrame, name: str, n: str, share: float = 0.3, factor: float = 20.0) -> DataFrame:
    """Merged sequences that stay: not (below share of the 0.9 quantile and below the 0.25 quantile), and not below the largest over factor."""
    q = counts.agg(F.struct(F.percentile(n, 0.9).alias("hi"), F.percentile(n, 0.25).alias("lo"), F.max(n).alias("top")).alias("q"))
    c = counts.withColumn("_q", q.scalar())
    return c.where(~(((F.col(n) < F.col("_q.hi") * share) & (F.col(n) < F.col("_q.lo"))) | (F.col(n) < F.col("_q.top") / factor))).select(name, n)


def rescued(candidates: DataFrame, profiles: DataFrame, genes: DataFrame, taken: DataFrame, least: float = 0.6) -> DataFrame:
    """gene, group, r: candidates (gene, group, category) whose profile goes with their group's, where the group has no gene of that category yet and the gene no group.

    profiles: group, sample, value; genes: gene, sample, value; taken: gene, group, category.
    """
    free = candidates.join(taken.select("group", "category").distinct(), ["group", "category"], "left_anti").join(taken.select("gene").distinct(), "gene", "left_anti")
    both = free.join(genes.withColumnRenamed("value", "x"), "gene").join(profiles.withColumnRenamed("value", "y"), ["group", "sample"])
    r = F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))
    return both.groupBy("gene", "group").agg(F.round(F.coalesce(F.nanvl(r, F.lit(0.0)), F.lit(0.0)), 4).alias("r")).where(F.col("r") >= least)


def declutter(members: DataFrame, merges: DataFrame, gene: str = "gene", member: str = "member") -> DataFrame:
    """gene, members: each merged gene's members go to its target, and the gene stays with none. merges: gene, target."""
    moved = members.join(merges, gene, "left").withColumn("_to", F.coalesce("target", gene))
    got = moved.groupBy(F.col("_to").alias(gene)).agg(F.array_sort(F.collect_set(member)).alias("members"))
    return members.select(gene).distinct().join(got, gene, "left").select(gene, F.coalesce("members", F.array().cast(got.schema["members"].dataType)).alias("members"))


def repeated_markers(markers: DataFrame, group: str, marker: str, gene: str) -> DataFrame:
    """group, marker, genes of markers that a group holds more than once."""
    return markers.groupBy(group, marker).agg(F.array_sort(F.collect_set(gene)).alias("genes")).where(F.size("genes") > 1)


def duration_seconds(text: Column) -> Column:
    """Seconds of ``1-02:03:04``, ``02:03:04`` or ``03:04``; null otherwise."""
    part = lambda i: F.coalesce(F.regexp_extract(text, r"^(?:(?:(\d+)-)?(\d+):)?(\d+):(\d+)$", i).try_cast("long"), F.lit(0))
    return F.when(text.rlike(r"^(?:(?:\d+-)?\d+:)?\d+:\d+$"), ((part(1) * 24 + part(2)) * 60 + part(3)) * 60 + part(4))


def gigabytes(text: Column) -> Column:
    """``500M`` or ``2G`` in GB; a bare number is GB."""
    n, unit = F.regexp_extract(text, r"^([\d.]+)\s*([KMGT]?)B?$", 1).try_cast("double"), F.regexp_extract(text, r"^([\d.]+)\s*([KMGT]?)B?$", 2)
    scale = F.when(unit == "K", 1.0 / 1024 / 1024).when(unit == "M", 1.0 / 1024).when(unit == "T", 1024.0).otherwise(1.0)
    return n * scale


def resolve_path(path: Column, environment: dict[str, str]) -> Column:
    """``$NAME`` at the start of a path's parts replaced, longer names first; unknown names stay."""
    for name in sorted(environment, key=len, reverse=True):
        path = F.regexp_replace(path, rf"\${name}\b", environment[name].replace("\\", "\\\\").replace("$", "\\$"))
    return path


def split_pair(header: Column, seq: Column, qual: Column) -> Column:
    """Two records (name, seq, qual) of a joined read whose header ends in ``;length;``: the mates lie before and after one separating letter."""
    n = F.regexp_extract(header, r"^(@.*);(\d+);", 2).try_cast("int")
    name = F.regexp_extract(header, r"^(@.*);(\d+);", 1)
    one = lambda mate, at: F.struct(F.concat(name, F.lit(f"/{mate}")).alias("name"), F.substring(seq, at, n).alias("seq"), F.substring(qual, at, n).alias("qual"))
    return F.when(n.isNotNull(), F.array(one(1, F.lit(1)), one(2, n + 2)))


def guide_groups(members: DataFrame, group: str, member: str, least: int) -> DataFrame:
    """group, n and sorted members of groups with at least so many."""
    return members.groupBy(group).agg(F.countDistinct(member).alias("n"), F.array_sort(F.collect_set(member)).alias("members")).where(F.col("n") >= least)


def common_ancestor(paths: DataFrame, group: str, path: str) -> DataFrame:
    """group, ancestor: the deepest node on all members' paths from the root (arrays, root first)."""
    n = paths.groupBy(group).agg(F.count("*").alias("_n"))
    each = paths.select(group, F.posexplode(path).alias("depth", "node")).groupBy(group, "depth", "node").agg(F.count("*").alias("_k")).join(n, group).where("_k = _n")
    return each.groupBy(group).agg(F.max_by("node", "depth").alias("ancestor"))


def as_fasta(reads: DataFrame, ids: DataFrame, name: str = "id") -> DataFrame:
    """One FASTA record a row of the reads whose id is assigned."""
    return reads.join(ids.select(name).distinct(), name, "left_semi").select(F.concat(F.lit(">"), F.col(name).cast("string"), F.lit("\n"), F.col("seq")).alias("record"))
