"""Annotation tables: terms, flags, hierarchies, gene indexes, contig expansion, transfers and per-gene taxonomy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def explode_terms(df: DataFrame, key: str, terms: str, sep: str = "[,;]") -> DataFrame:
    """key and term of a multi-label column; blanks go, repeats within a row count once."""
    each = F.array_distinct(F.filter(F.transform(F.split(terms, sep), lambda x: F.trim(x)), lambda x: x != ""))
    return df.select(key, F.explode(each).alias("term"))


def flagged(columns: list[str], yes: str = "YES") -> Column:
    """Names of the columns that hold ``yes``, in the order given."""
    return F.array_compact(F.array(*[F.when(F.col(c) == yes, F.lit(c)) for c in columns]))


def hierarchy_levels(df: DataFrame, code: str, sep: str = ".") -> DataFrame:
    """df with level (from 0) and name of every prefix of a dotted code."""
    parts = F.split(code, f"\\Q{sep}\\E")
    each = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct((i - 1).alias("level"), F.array_join(F.slice(parts, 1, i), sep).alias("name")))
    return df.withColumn("_l", F.explode(each)).select(*df.columns, "_l.level", "_l.name")


def first_of_family(df: DataFrame, group: str, gene: str, family: str, order: list[str], limit: int | None = None) -> DataFrame:
    """group, gene, family: the first gene of each family; a gene without one (blank or ``-``) is its own, named uniq1, uniq2, ...

    With a limit, only the first so many of a group stay.
    """
    blank = F.coalesce(F.trim(family), F.lit("")).isin("", "-")
    w = W.partitionBy(group).orderBy(*order)
    named = df.withColumn("_k", F.when(blank, F.concat(F.lit("uniq"), F.sum(blank.cast("int")).over(w).cast("string"))).otherwise(F.col(family)))
    first = named.withColumn("_n", F.row_number().over(W.partitionBy(group, "_k").orderBy(*order))).where("_n = 1")
    if limit is not None:
        first = first.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= limit)
    return first.select(group, gene, F.col("_k").alias(family))


def wide_records(line: Column, width: int = 8, key: int = 1, value: int = 6) -> Column:
    """Structs key and value of a tab-separated line that repeats records of ``width`` fields; an unfinished record is left out."""
    f = F.split(line, "\t")
    n = F.floor((F.size(f) - value - 1) / width).cast("int")
    at = F.when(F.size(f) > value, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(F.regexp_replace(F.get(f, i * width + key), r"\s", "").alias("key"), F.get(f, i * width + value).alias("value")))


def pair_files(files: DataFrame, name: str, first: str, second: str) -> DataFrame:
    """stem, r1, r2, paired: files matched by what is left of their names without the read mark; first and second are patterns of the mark."""
    mark = F.when(F.col(name).rlike(first), 1).when(F.col(name).rlike(second), 2)
    stem = F.when(F.col(name).rlike(first), F.regexp_replace(name, first, "")).when(F.col(name).rlike(second), F.regexp_replace(name, second, "")).otherwise(F.col(name))
    g = files.select(stem.alias("stem"), F.col(name).alias("file"), mark.alias("mark")).groupBy("stem")
    out = g.agg(F.min(F.when(F.coalesce("mark", F.lit(1)) == 1, F.col("file"))).alias("r1"), F.min(F.when(F.col("mark") == 2, F.col("file"))).alias("r2"))
    return out.withColumn("paired", F.col("r1").isNotNull() & F.col("r2").isNotNull())


def split_by_divergence(df: DataFrame, divergence: str, length: str, most: float = 0.05, least: int = 100) -> DataFrame:
    """df with fate: accepted, queued again (diverged, but longer than ``least``) or dropped."""
    return df.withColumn("fate", F.when(F.col(divergence) <= most, "accepted").when(F.col(length) > least, "queued").otherwise("dropped"))


def of_passing(df: DataFrame, passing: DataFrame, group: str) -> DataFrame:
    return df.join(passing.select(group).distinct(), group, "left_semi")


def short_header(header: Column, mate: int, most: int = 255, keep: int = 250) -> Column:
    """Headers of ``most`` and more characters are cut to ``keep`` and get their mate's mark."""
    return F.when(F.length(header) >= most, F.concat(F.substring(header, 1, keep), F.lit(f"/{mate}"))).otherwise(header)


def contigs_by_kingdom(hits: DataFrame, kingdoms: DataFrame, evalue: float = 1e-11, pident: float = 70.0) -> DataFrame:
    """query and prokaryote of hits within limits; the taxon is the number before the subject's first dot. kingdoms: taxid, kingdom (0 and 1 are prokaryotes).

    A query with one prokaryotic hit is prokaryotic; taxa without a kingdom are left out.
    """
    ok = hits.where((F.col("evalue") <= evalue) & (F.col("pident") >= pident)).select("query", F.regexp_extract("subject", r"^(\d+)\.", 1).try_cast("long").alias("taxid"))
    return ok.join(kingdoms, "taxid").groupBy("query").agg(F.bool_or(F.col("kingdom").isin(0, 1)).alias("prokaryote"))


def guarded(hits: DataFrame, bits: float = 120.0, evalue: float = 1e-14) -> DataFrame:
    """Hits below the guards stay and lose their identity, so that they cannot decide a rank."""
    return hits.withColumn("pident", F.when((F.col("bitscore") < bits) | (F.col("evalue") > evalue), F.lit(0.0)).otherwise(F.col("pident")))


def sample_range(samples: DataFrame, ordinal: str, name: str, first: int = 0, last: int | None = None, ignore: tuple[str, ...] = ()) -> DataFrame:
    keep = F.col(ordinal) >= first if last is None else F.col(ordinal).between(first, last)
    return samples.where(keep & ~F.coalesce(F.col(name).isin(*ignore), F.lit(False)) if ignore else keep)


def contig_genes(contigs: DataFrame, genes: DataFrame, bin_: str = "bin") -> DataFrame:
    """bin, genes: genes of a bin's contigs in contig and gene order, an empty element after each contig; contigs without a gene are left out.

    contigs: bin, sample, contig; genes: sample, contig, ordinal, gene.
    """
    j = contigs.join(genes, ["sample", "contig"])
    own = j.groupBy(bin_, "sample", "contig").agg(F.array_sort(F.collect_list(F.struct("ordinal", F.col("gene").cast("string").alias("gene")))).alias("_g"))
    own = own.withColumn("_g", F.concat(F.transform("_g", lambda x: x["gene"]), F.array(F.lit(""))))
    lists = own.groupBy(bin_).agg(F.array_sort(F.collect_list(F.struct("sample", "contig", "_g"))).alias("_c"))
    return lists.select(bin_, F.flatten(F.transform("_c", lambda x: x["_g"])).alias("genes"))


def genes_by_contig(genes: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """sample, contig, ordinals (ascending); keep: sample, contig to stay with."""
    g = genes if keep is None else genes.join(keep.select("sample", "contig").distinct(), ["sample", "contig"], "left_semi")
    return g.groupBy("sample", "contig").agg(F.array_sort(F.collect_set("ordinal")).alias("ordinals"))


def submatrices(matrix: DataFrame, members: DataFrame, feature: str = "feature") -> DataFrame:
    """Rows of a long matrix once for each group of their feature; written with partitionBy, one folder a group."""
    return matrix.join(members.distinct(), feature)


def with_metadata(df: DataFrame, samples: DataFrame, key: str, column: str) -> DataFrame:
    """Rows of samples whose metadata column is filled."""
    return df.join(samples.where(F.coalesce(F.trim(F.col(column).cast("string")), F.lit("")) != "").select(key, column).distinct(), key)


def transfer(groups: DataFrame, names: DataFrame, old: str, new: str, item: str) -> DataFrame:
    """new, items: sets under their new names (names: old, new); sets that get one name are united, those without one keep theirs."""
    n = groups.join(names.select(F.col(old), F.col(new).alias("_new")), old, "left").withColumn(new, F.coalesce("_new", old))
    return n.groupBy(new).agg(F.array_sort(F.collect_set(item)).alias("items"))


def relabel(df: DataFrame, names: DataFrame, key: str, label: str, default: str | None = None) -> DataFrame:
    return df.join(names.select(key, label), key, "left").withColumn(label, F.coalesce(F.col(label), F.lit(default)) if default is not None else F.col(label))


def attach_sequences(ids: DataFrame, index: DataFrame, sequences: DataFrame, gene: str = "gene", member: str = "member") -> DataFrame:
    """gene, seq: the sequence of a gene's member under each gene that lists it (index: gene, member; sequences: member, seq)."""
    return index.join(ids.select(gene).distinct(), gene, "left_semi").join(sequences, member).select(gene, "seq")


def invert(df: DataFrame, a: str, b: str) -> DataFrame:
    """b, and the sorted set of a."""
    return df.groupBy(b).agg(F.array_sort(F.collect_set(a)).alias(a))


def last_wins(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """key, value, repeats: the value that comes last, and how many came before it."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value), (F.count("*") - 1).alias("repeats"))


def rewrite_ranks(lineage: Column, rules: list[tuple[int, str, int, str]]) -> Column:
    """Ordered rules (rank, name, rank to set, new name), each seeing what those before it left."""


    def put(at: int, name: str):
        return lambda x, i: F.when(i == at, F.lit(name)).otherwise(x)

    for rank, name, to, new in rules:
        lineage = F.when(F.get(lineage, F.lit(rank)) == name, F.transform(lineage, put(to, new))).otherwise(lineage)
    return lineage


def gene_lineages(genes: DataFrame, genomes: DataFrame, prefixes: str = "kpcofgs") -> DataFrame:
    """gene, lineage: the genome's ranks with k__, p__, ... before them. genes: gene, genome; genomes: genome, ranks."""
    marks = F.array(*[F.lit(f"{p}__") for p in prefixes])
    named = F.zip_with(marks, F.slice("ranks", 1, len(prefixes)), lambda m, r: F.concat(m, F.coalesce(r, F.lit(""))))
    return genes.join(genomes, "genome").select("gene", F.array_join(named, ";").alias("lineage"))


def repaired_names(members: DataFrame, known: DataFrame, sep: str = "__") -> DataFrame:
    """member with its sample replaced by the known sample of its contig where the two differ. members: member (sample__contig_...); known: contig, sample."""
    parts = F.split("member", f"\\Q{sep}\\E", 2)
    m = members.withColumn("_s", parts[0]).withColumn("_r", parts[1]).withColumn("contig", F.regexp_extract("_r", r"^([^_]+)", 1))
    j = m.join(known.select("contig", F.col("sample").alias("_k")), "contig", "left")
    return j.select("member", F.concat(F.coalesce("_k", "_s"), F.lit(sep), F.col("_r")).alias("repaired"))


def ranked_paths(taxa: DataFrame, ranks: DataFrame, wanted: tuple[str, ...], sep: str = ";") -> DataFrame:
    """id, lineage: the names on a taxon's path at the wanted ranks, ``?`` where the path has none. taxa: id, path; ranks: path (of every node), rank."""
    parts = F.split("path", f"\\Q{sep}\\E")
    each = taxa.select("id", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.struct(F.array_join(F.slice(parts, 1, i), sep).alias("path"), F.get(parts, i - 1).alias("name")))).alias("p"))
    found = each.select("id", "p.path", "p.name").join(ranks, "path").where(F.col("rank").isin(*wanted)).groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct("rank", "name"))).alias("m"))
    names = F.array(*[F.coalesce(F.try_element_at("m", F.lit(r)), F.lit("?")) for r in wanted])
    return taxa.select("id").join(found, "id", "left").select("id", F.coalesce(names, F.array_repeat(F.lit("?"), len(wanted))).alias("lineage"))


def gene_functions(tables: dict[str, DataFrame], database: str) -> DataFrame:
    """gene, terms of one database class; classes have their own column names, the first is the gene and the second its terms."""
    if database not in tables:
        raise ValueError(f"no table for {database} among {sorted(tables)}")
    t = tables[database]
    return t.select(F.col(t.columns[0]).alias("gene"), F.col(t.columns[1]).alias("terms"))
