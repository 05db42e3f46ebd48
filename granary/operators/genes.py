"""Genes, markers, reads and their assignment to clusters and species."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def to_clusters(genes: DataFrame, index: DataFrame, member: str, strict: bool = True) -> DataFrame:
    """Genes with their cluster; strict: a gene without one raises at run time."""
    j = genes.join(index, member, "left" if strict else "inner")
    return j.withColumn("cluster", F.when(F.col("cluster").isNull(), F.raise_error(F.concat(F.lit("no cluster for "), F.col(member).cast("string")))).otherwise(F.col("cluster"))) if strict else j


def first_known(*cols: Column) -> Column:
    """The first value that is neither null, blank nor ``?``."""
    return F.coalesce(*[F.when(~F.trim(c).isin("", "?", "-"), c) for c in cols])


def core_genes(occ: DataFrame, group: str, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Markers, and genes with multi / occ < 0.1 and 0.9 < multibin < 3 whose occurrence lies within the group's quantile band. occ: group, gene, occ, multi, multibin, is_marker."""
    ok = occ.where("is_marker or (multi / occ < 0.1 and multibin > 0.9 and multibin < 3)")
    q = ok.groupBy(group).agg(F.expr(f"percentile_disc({low}) within group (order by occ)").alias("_lo"), F.expr(f"percentile_disc({high}) within group (order by occ)").alias("_hi"))
    return ok.join(q, group).where("is_marker or (occ >= _lo and occ <= _hi)").drop("_lo", "_hi")


def conspecific_free(df: DataFrame, sample: str, gene: str, csp: str, copies: str, max_csp: float = 0.1, max_dup: float = 0.15, max_share: float = 0.05, least: int = 10) -> DataFrame:
    """Single-copy genes of low score in samples whose duplicate and conspecific rates are low and that keep at least ``least`` genes."""
    rate = df.groupBy(sample).agg((F.count_if(F.col(copies) > 1) / F.count("*")).alias("_d"), (F.count_if(F.col(csp) > max_csp) / F.count("*")).alias("_c"))
    kept = df.join(rate, sample).where((F.col("_d") <= max_dup) & (F.col("_c") < max_share) & (F.col(csp) <= max_csp) & (F.col(copies) == 1))
    return kept.withColumn("_n", F.count("*").over(W.partitionBy(sample))).where(F.col("_n") >= least).drop("_n", "_d", "_c")


def read_passes(seq: Column, qual: Column, least: int = 50, most: int = 400, mean_quality: float = 20, ambiguous: int = 2, homopolymer: int = 10) -> Column:
    """Length, mean quality (Phred+33), ambiguous bases and longest run of one base within limits."""
    scores = F.transform(F.split(qual, ""), lambda c: F.ascii(c) - 33)
    mean = F.aggregate(scores, F.lit(0), lambda a, x: a + x) / F.greatest(F.length(qual), F.lit(1))
    n = F.length(seq) - F.length(F.replace(seq, F.lit("N"), F.lit("")))
    return F.length(seq).between(least, most) & (mean >= mean_quality) & (n <= ambiguous) & ~seq.rlike(rf"([ACGT])\1{{{homopolymer},}}")


def unassigned(df: DataFrame, query: str, *assigned: DataFrame) -> DataFrame:
    """Rows that no earlier database has assigned (lineage null, empty or beginning with ``?``)."""
    for a in assigned:
        df = df.join(a.where("lineage is not null and size(lineage) > 0 and lineage[0] != '?'"), query, "left_anti")
    return df


def marker_table(df: DataFrame, group: str, category: str, gene: str, categories: list[str]) -> DataFrame:
    """A column of comma-joined genes for each category, and the mean number of copies over the categories present."""
    n = df.groupBy(group, category).agg(F.array_join(F.sort_array(F.collect_set(F.col(gene).cast("string"))), ",").alias("g"), F.countDistinct(gene).alias("k"))
    wide = n.groupBy(group).pivot(category, categories).agg(F.first("g"))
    return wide.join(n.groupBy(group).agg(F.round(F.avg("k"), 4).alias("copies")), group)


def coverage_summary(depth: DataFrame, key: list[str], value: str) -> DataFrame:
    """key, places, mean, median and share covered."""
    return depth.groupBy(*key).agg(F.count("*").alias("places"), F.round(F.avg(value), 4).alias("mean"), F.median(value).alias("median"), F.round(F.count_if(F.col(value) > 0) / F.count("*"), 4).alias("covered"))


def contig_completeness(genes: DataFrame, contig: str, gene: str, members: DataFrame, least: float = 0.5) -> DataFrame:
    """contig, share of its genes among members (gene), where at least ``least``."""
    m = members.select(gene).distinct().withColumn("_in", F.lit(1))
    s = genes.join(m, gene, "left").groupBy(contig).agg((F.count("_in") / F.count("*")).alias("share"))
    return s.where(F.col("share") >= least)


def representative_member(df: DataFrame, group: str, member: str, flagged: Column, prefix: str = "Cano__") -> DataFrame:
    """The flagged member, else the smallest that does not begin with prefix, else the smallest."""
    w = W.partitionBy(group).orderBy(F.when(flagged, 0).when(~F.col(member).startswith(prefix), 1).otherwise(2), member)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(group, member)


def rank_genes(occ: DataFrame, group: str, gene: str, band: tuple[float, float] = (0.5, 1.5)) -> DataFrame:
    """group, gene, place: markers first (multibin at most the group's upper quartile, capped at 2.2), then others by occurrence within the band around the mean."""
    q = occ.groupBy(group).agg(F.least(F.expr("percentile_disc(0.75) within group (order by multibin)"), F.lit(2.2)).alias("_q"), F.avg("occ").alias("_a"))
    k = occ.join(q, group).where(f"(is_marker and multibin <= _q) or (not is_marker and occ between {band[0]} * _a and {band[1]} * _a)")
    w = W.partitionBy(group).orderBy(F.desc("is_marker"), F.desc("occ"), gene)
    return k.select(group, gene, F.row_number().over(w).alias("place"))


def lineage_from_parents(nodes: DataFrame, ranks: tuple[str, ...], depth: int = 40) -> DataFrame:
    """id, lineage: names at the given ranks up the parent chain; pointers double each round, so a chain of n takes log n joins. nodes: id, parent, rank, name."""
    up = nodes.select("id", F.col("id").alias("at"), "parent", F.map_from_arrays(F.array("rank"), F.array("name")).alias("m"))
    reach = 1
    while reach < depth:
        step = up.select(F.col("id").alias("p"), F.col("parent").alias("pp"), F.col("m").alias("pm"))
        clean = F.map_filter("pm", lambda k, v: ~F.map_contains_key(F.col("m"), k))
        up = up.join(step, (F.col("parent") == F.col("p")) & (F.col("parent") != F.col("id")), "left").select("id", "at", F.coalesce("pp", "parent").alias("parent"), F.when(F.col("pm").isNull(), F.col("m")).otherwise(F.map_concat("m", clean)).alias("m"))
        reach *= 2
    return up.select("id", F.array(*[F.coalesce(F.try_element_at("m", F.lit(r)), F.lit("?")) for r in ranks]).alias("lineage"))


def extract_genes(contigs: DataFrame, genes: DataFrame, contig: str) -> DataFrame:
    """gene and its sequence by 1-based inclusive coordinates; the minus strand is reverse-complemented."""
    from ..functions.sequence import reverse_complement

    s = F.expr("substring(seq, start, end - start + 1)")
    return genes.join(contigs, contig).select(contig, "gene", F.when(F.col("strand") == "-", reverse_complement(s)).otherwise(s).alias("seq"))


def best_assignment(df: DataFrame, gene: str, target: str, r: str, near: float = 0.01) -> DataFrame:
    """gene, target: the target with the highest correlation; ties within ``near`` go to the smaller target."""
    top = F.max(r).over(W.partitionBy(gene))
    return df.withColumn("_t", top).where(F.col(r) >= F.col("_t") - near).groupBy(gene).agg(F.min(target).alias(target))


def cluster_union(a: DataFrame, b: DataFrame, group: str, gene: str, least: float, forced: DataFrame) -> DataFrame:
    """Genes of either clustering: in both, or with a score of at least ``least`` in one, or forced. a and b: group, gene, score."""
    j = a.withColumnRenamed("score", "sa").join(b.withColumnRenamed("score", "sb"), [group, gene], "full_outer")
    kept = j.where(F.expr(f"(sa is not null and sb is not null) or greatest(sa, sb) >= {least}")).select(group, gene)
    return kept.union(forced.select(group, gene)).distinct()


def covered_by_hits(hits: DataFrame, contig: str, length: str, aln_len: str, pident: str, least: float = 0.8, identity: float = 95.0) -> DataFrame:
    """Contigs whose hits above the identity cover at least ``least`` of their length."""
    s = hits.where(F.col(pident) > identity).groupBy(contig).agg(F.sum(aln_len).alias("_s"), F.max(length).alias("_l"))
    return s.where(F.col("_s") >= least * F.col("_l")).select(contig)


def shared_vectors(df: DataFrame, group: str, vector: str, digits: int = 3) -> DataFrame:
    """group, i, value: element-wise sums rescaled to 100."""
    each = df.select(group, F.posexplode(vector).alias("i", "x")).groupBy(group, "i").agg(F.sum("x").alias("s"))
    total = F.sum("s").over(W.partitionBy(group))
    return each.select(group, "i", F.round(F.when(total == 0, 0.0).otherwise(100.0 * F.col("s") / total), digits).alias("value"))


def segments(df: DataFrame, by: list[str], order: list[str], sentinel: Column) -> DataFrame:
    """Adds segment: how many sentinel rows stand at or before each row; sentinel rows go."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("segment", F.sum(F.when(sentinel, 1).otherwise(0)).over(w)).where(~sentinel)


def replicate_by_coverage(contigs: DataFrame, coverage: str, size: int, most: int) -> DataFrame:
    """Each contig's pieces of ``size``, repeated by its rounded coverage (at most ``most`` times). contigs: id, seq."""
    from ..functions.sequence import chunks

    times = F.least(F.greatest(F.round(F.col(coverage)).cast("int"), F.lit(1)), F.lit(most))
    p = contigs.withColumn("_k", times).select("id", "_k", F.explode(chunks(F.col("seq"), size)).alias("c"))
    return p.select("id", F.explode(F.sequence(F.lit(1), F.col("_k"))).alias("copy"), "c.start", "c.end", "c.seq")


def rename_contigs(contigs: DataFrame, tag: str, circular: Column) -> DataFrame:
    """old, new (``tag__C<n>_L=<length>=``, longest first) and circular; lengths are counted from the sequence for every contig. One sample at a time."""
    from .assembly import numbered

    c = numbered(contigs.withColumn("_len", F.length("seq")), -F.col("_len"), ["id"], "_place")
    return c.select(F.col("id").alias("old"), F.format_string(f"{tag}__C%d_L=%d=", F.col("_place"), F.col("_len")).alias("new"), circular.alias("circular"))


def interleave(first: DataFrame, second: DataFrame) -> DataFrame:
    """id, seq, qual: mate one, a separator N, and the reverse complement of mate two."""
    from ..functions.sequence import reverse_complement

    b = second.select("id", F.col("seq").alias("_s"), F.col("qual").alias("_q"))
    return first.join(b, "id").select("id", F.concat("seq", F.lit("N"), reverse_complement(F.col("_s"))).alias("seq"), F.concat("qual", F.lit("!"), F.reverse("_q")).alias("qual"))


def nearest(distances: DataFrame, k: int = 10, beyond: float = 0.01) -> DataFrame:
    """Of a, b, distance the k nearest b of each a farther than ``beyond`` (ties to the smaller b)."""
    w = W.partitionBy("a").orderBy("distance", "b")
    return distances.where(F.col("distance") > beyond).withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def resistance_hits(hits: DataFrame, subjects: DataFrame) -> DataFrame:
    """query, classes, drugs of hits with evalue < 1e-5 that reach their subject's lowest identity threshold. subjects: subject, min_id, class, drug."""
    low = subjects.groupBy("subject").agg(F.min("min_id").alias("min_id"), F.collect_set("class").alias("c"), F.collect_set("drug").alias("d"))
    ok = hits.join(low, "subject").where("evalue < 1e-5 and pident >= min_id")
    flat = lambda x: F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_list(x)))), ",")
    return ok.groupBy("query").agg(flat("c").alias("classes"), flat("d").alias("drugs"))


def chimeric_contigs(alignments: DataFrame, contig: str, length: str, aln_len: str, share: float = 0.995, slack: int = 10) -> DataFrame:
    """contig, covered, chimeric: whether its alignments add up to less than share * length - slack."""
    s = alignments.groupBy(contig).agg(F.sum(aln_len).alias("covered"), F.max(length).alias("_l"))
    return s.select(contig, "covered", (F.col("covered") < share * F.col("_l") - slack).alias("chimeric"))
