"""Readers and writers of the native text formats, on Spark's text and CSV sources (compressed files are read by suffix)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

M8 = "query string, subject string, pident double, aln_len int, mism int, gaps int, qs int, qe int, ss int, se int, evalue double, bitscore double"
SAM = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")


def read_fasta(spark: SparkSession, path: str, cut: str | None = None) -> DataFrame:
    """id, seq: records split at ``>``; cut ends the id at a separator; white space in sequences goes, empty records stay."""
    r = spark.read.text(path, lineSep="\n>").where("trim(value) != ''")
    v = F.regexp_replace("value", "^>", "")
    head = F.trim(F.regexp_extract(v, r"^([^\r\n]*)", 1))
    name = F.substring_index(head, cut, 1) if cut else head
    return r.select(name.alias("id"), F.regexp_replace(F.regexp_replace(v, r"^[^\r\n]*", ""), r"\s", "").alias("seq"))


def read_fasta_headers(spark: SparkSession, path: str, full: bool = True) -> DataFrame:
    """id of every record: only lines that begin with ``>`` are kept."""
    h = F.regexp_replace("value", "^>", "")
    return spark.read.text(path).where(F.col("value").startswith(">")).select((h if full else F.regexp_extract(h, r"^(\S+)", 1)).alias("id"))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """id, seq, qual of four-line records. Files are split where a line begins with @, so a large file is read by many tasks.

    A quality line that begins with @ is cut off its record that way: such records lack their fourth line and are joined with the piece that follows;
    only they are put in order, file by file.
    """
    t = spark.read.text(path, lineSep="\n@").select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"), F.split(F.regexp_replace("value", r"\r", ""), "\n").alias("l"))
    t = t.withColumn("l", F.filter("l", lambda x: x != ""))
    whole = t.where("size(l) = 4").select("l")
    broken = t.where("size(l) in (1, 3)").withColumn("q", F.lead("l").over(W.partitionBy("f").orderBy("i"))).where("size(l) = 3 and size(q) = 1")
    l = broken.select(F.concat("l", F.transform("q", lambda x: F.concat(F.lit("@"), x))).alias("l")).union(whole)
    return l.select(F.regexp_replace(F.get("l", F.lit(0)), "^@", "").alias("id"), F.get("l", F.lit(1)).alias("seq"), F.get("l", F.lit(3)).alias("qual"))


def read_tsv(spark: SparkSession, path: str, schema: str, comment: str = "#") -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schema, comment=comment, quote="")


def read_m8(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, M8)


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """seqid, start, end, strand, attrs (map), gene (``>seqid_n`` from ID=x_n), partial."""
    g = read_tsv(spark, path, "seqid string, source string, type string, start int, end int, score string, strand string, phase string, attributes string")
    attrs = F.str_to_map(F.regexp_replace("attributes", ";$", ""), F.lit(";"), F.lit("="))
    g = g.withColumn("attrs", attrs)
    n = F.regexp_extract(F.col("attrs")["ID"], r"_(\d+)$", 1)
    return g.select("seqid", "start", "end", "strand", "attrs", F.concat(F.lit(">"), "seqid", F.lit("_"), n).alias("gene"), F.col("attrs")["partial"].alias("partial"))


def partial_class(p: Column) -> Column:
    return F.when(p == "00", "complete").when(p == "01", "open_3").when(p == "10", "open_5").when(p == "11", "fragment")


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """The eleven fields and tags (map of name to value); header lines are skipped."""
    p = spark.read.text(path).where(~F.col("value").startswith("@")).select(F.split("value", "\t").alias("p"))
    tags = F.map_from_entries(F.transform(F.slice("p", F.lit(12), F.greatest(F.size("p") - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2), F.regexp_replace(t, "^..:.:", ""))))
    cols = [F.get("p", F.lit(i)).cast("int" if n in ("flag", "pos", "mapq", "pnext", "tlen") else "string").alias(n) for i, n in enumerate(SAM)]
    return p.select(*cols, tags.alias("tags"))


def alignment_passes(sam: DataFrame, max_divergence: float = 0.05, cover: float = 0.8, mapq: int = 20, clip: int = 0) -> DataFrame:
    """Aligned rows that pass divergence (NM over the unclipped length), cover, quality and both-end clipping; unmapped rows stay."""
    from ..functions.sequence import cigar_length

    c, n = F.col("cigar"), F.length("seq")
    clipped = cigar_length(c, "HS")
    length = F.greatest(n - clipped, F.lit(1))
    ends = F.least(F.coalesce(F.regexp_extract(c, r"^(\d+)[HS]", 1).try_cast("int"), F.lit(0)), F.coalesce(F.regexp_extract(c, r"(\d+)[HS]$", 1).try_cast("int"), F.lit(0)))
    nm = F.coalesce(F.col("tags")["NM"].try_cast("int"), F.lit(0))
    ok = (nm / length <= max_divergence) & (1 - (cigar_length(c, "I") + clipped) / F.greatest(n, F.lit(1)) >= cover) & (F.col("mapq") >= mapq) & (ends <= clip)
    return sam.where((F.col("flag").bitwiseAND(4) != 0) | ok)


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """chrom, pos, ref, alt, qual, info (map) and fmt (map of the first sample)."""
    p = spark.read.text(path).where(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("p"))
    info = F.str_to_map(F.get("p", F.lit(7)), F.lit(";"), F.lit("="))
    fmt = F.map_from_arrays(F.split(F.get("p", F.lit(8)), ":"), F.split(F.get("p", F.lit(9)), ":"))
    return p.select(F.get("p", F.lit(0)).alias("chrom"), F.get("p", F.lit(1)).cast("int").alias("pos"), F.get("p", F.lit(3)).alias("ref"), F.get("p", F.lit(4)).alias("alt"), F.get("p", F.lit(5)).try_cast("double").alias("qual"), info.alias("info"), F.when(F.size("p") > 9, fmt).alias("fmt"))


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """cluster, member from ``id <tab> >a,>b``; comments are skipped."""
    t = read_tsv(spark, path, "cluster long, members string")
    return t.select("cluster", F.explode(F.split("members", ",")).alias("member")).select("cluster", F.regexp_replace("member", "^>", "").alias("member"))


def read_cluster_blocks(spark: SparkSession, path: str) -> DataFrame:
    """cluster, member, representative, identity of ``>Cluster n`` blocks; a block is one record, so order inside a file does not matter."""
    b = spark.read.text(path, lineSep=">Cluster ").where("trim(value) != ''")
    rows = b.select(F.regexp_extract("value", r"^(\d+)", 1).cast("long").alias("cluster"), F.explode(F.split("value", "\n")).alias("l")).where(F.col("l").contains(">"))
    return rows.select("cluster", F.regexp_extract("l", r">(.+?)\.\.\.", 1).alias("member"), F.col("l").rlike(r"\*\s*$").alias("representative"), F.regexp_extract("l", r"([\d.]+)%", 1).try_cast("double").alias("identity"))


def cluster_blocks(df: DataFrame, core: str, member: str) -> DataFrame:
    """cluster (from 0), member, representative: a member equal to its core represents it. Numbers follow a hash of the core, so that no task orders all cores."""
    from ..operators.assembly import numbered

    ids = numbered(df.select(core).distinct(), F.pmod(F.xxhash64(core), F.lit(1 << 16)), [core], "cluster").withColumn("cluster", F.col("cluster") - 1)
    return df.join(ids, core).select("cluster", F.col(member).alias("member"), (F.col(member) == F.col(core)).alias("representative"))


def read_hmmer(spark: SparkSession, path: str, least: float = 0.0) -> DataFrame:
    """target, query, score of a domain table at or above least."""
    p = spark.read.text(path).where(~F.col("value").startswith("#")).select(F.split(F.trim("value"), r"\s+").alias("p"))
    return p.select(F.get("p", F.lit(0)).alias("target"), F.get("p", F.lit(3)).alias("query"), F.get("p", F.lit(7)).cast("double").alias("score")).where(F.col("score") >= least)


def read_cutoffs(spark: SparkSession, path: str, calibrated: bool = True) -> DataFrame:
    """marker, cutoff of a cut-off table; its first line tells whether it was calibrated, and a table of the other kind raises."""
    lines = spark.read.text(path)
    if not lines.where(F.col("value").startswith("#CALIBRATED" if calibrated else "#UNCALIBRATED")).limit(1).count():
        raise ValueError(f"{path} is not {'a' if calibrated else 'an un'}calibrated cut-off table")
    p = lines.where(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("p"))
    return p.select(F.get("p", F.lit(0)).alias("marker"), F.get("p", F.lit(1)).try_cast("double").alias("cutoff"))


def read_bin_quality(spark: SparkSession, path: str) -> DataFrame:
    """bin, compl, conta, hetero of a quality report; reports whose name holds ``.cm2`` have them in columns 2 and 3 (hetero 0), others in 12 to 14."""
    p = spark.read.text(path).select(F.split("value", "\t").alias("p")).where(~F.get("p", F.lit(0)).isin("Bin Id", "Name"))
    at = (1, 2, None) if ".cm2" in path else (11, 12, 13)
    number = lambda i: F.lit(0.0) if i is None else F.get("p", F.lit(i)).try_cast("double")
    return p.select(F.get("p", F.lit(0)).alias("bin"), *[number(i).alias(c) for i, c in zip(at, ("compl", "conta", "hetero"), strict=True)])


def read_bins(spark: SparkSession, path: str) -> DataFrame:
    """contig, bin of an assignment table; bin 0 is none."""
    return spark.read.csv(path, sep="\t", schema="contig string, bin string").where("bin != '0'")


def read_gene_sets(spark: SparkSession, path: str) -> DataFrame:
    """group, gene and line, the place of the row in its file by file and offset order, for rules where the last one wins."""
    t = spark.read.csv(path, sep="\t", schema="group string, gene string")
    return t.withColumn("line", F.monotonically_increasing_id())


def read_matrix(spark: SparkSession, path: str, keep: DataFrame | None = None) -> DataFrame:
    """feature, sample, value of a matrix with samples in the header; keep (feature) restricts rows and never the header."""
    from ..operators.matrix import long, rows_of

    m = spark.read.csv(path, sep="\t", header=True)
    m = m.withColumnRenamed(m.columns[0], "feature")
    m = m.select("feature", *[F.col(f"`{c}`").try_cast("double").alias(c) for c in m.columns[1:]])
    return long(m if keep is None else rows_of(m, keep, "feature"), "feature")


def read_sample_map(spark: SparkSession, path: str) -> DataFrame:
    """sample, cells (array of the row's fields), directives (map of those above it); duplicate samples raise at run time.

    Directives hold for the rows after them, so a map (a small configuration file) is ordered as a whole.
    """
    t = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("n", "l")).where("trim(l) != ''")
    t = t.withColumn("p", F.split("l", "\t")).withColumn("d", F.when(F.col("l").startswith("#") & ~F.col("l").startswith("#SmplID"), F.col("p")))
    w = W.partitionBy(F.lit(0)).orderBy("n")
    names = ("#DirPath", "#OutPath", "#RunID", "#WARNING", "#RelaxSMPLID", "#NodeTmpDir", "#GlobalTmpDir", "#mocatFiltPath", "#illuminaClip")
    last = [F.last(F.when(F.get("d", F.lit(0)) == k, F.get("d", F.lit(1))), ignorenulls=True).over(w) for k in names]
    t = t.withColumn("directives", F.map_filter(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*last)), lambda k, v: v.isNotNull()))
    rows = t.where(~F.col("l").startswith("#")).select(F.get("p", F.lit(0)).alias("sample"), F.col("p").alias("cells"), "directives")
    twice = F.count("*").over(W.partitionBy("sample")) > 1
    return rows.withColumn("sample", F.when(twice, F.raise_error(F.concat(F.lit("duplicate sample "), "sample"))).otherwise(F.col("sample")))


def normalize_taxonomy(t: Column) -> Column:
    """Rank letters, quotes and brackets go; empty ranks become ``?``."""
    ranks = F.split(F.regexp_replace(t, r"[\"'\[\]]", ""), r";\s*")
    return F.transform(ranks, lambda x: F.when(F.regexp_replace(x, "^[kpcofgsd]__", "") == "", "?").otherwise(F.regexp_replace(x, "^[kpcofgsd]__", "")))


def newick_edges(text: str) -> list[tuple[int, int | None, str, float]]:
    """node, parent, name, length of every node of one tree."""
    out: list[list] = [[0, None, "", 0.0]]
    at, word, in_length = 0, "", False

    def close() -> None:
        nonlocal word, in_length
        if in_length:
            out[at][3] = float(word or 0)
        elif word:
            out[at][2] = word
        word, in_length = "", False

    for c in text.strip():
        if c == "(":
            out.append([len(out), at, "", 0.0])
            at = len(out) - 1
        elif c in ",);":
            close()
            if c == ",":
                out.append([len(out), out[at][1], "", 0.0])
                at = len(out) - 1
            elif c == ")":
                at = out[at][1]
        elif c == ":":
            close()
            in_length = True
        else:
            word += c
    return [tuple(x) for x in out]


def leaf_distances(edges: list[tuple[int, int | None, str, float]]) -> dict[tuple[str, str], float]:
    """Path lengths between named leaves of one tree."""
    parent = {n: (p, ln) for n, p, _, ln in edges}
    inner = {p for _, p, _, _ in edges}
    up: dict[str, dict[int, float]] = {}
    for n, _, name, _ in edges:
        if n not in inner:
            d, path, k = 0.0, {n: 0.0}, n
            while parent[k][0] is not None:
                d += parent[k][1]
                k = parent[k][0]
                path[k] = d
            up[name] = path
    names = sorted(up)
    return {(a, b): min(up[a][k] + up[b][k] for k in up[a].keys() & up[b].keys()) for i, a in enumerate(names) for b in names[i + 1 :]}


def write_fasta(df: DataFrame, path: str, name: str = "id", seq: str = "seq", most: int | None = None, files: int | None = None) -> None:
    """Records as text; most limits them in order of name, files splits them."""
    d = df.orderBy(name).limit(most) if most is not None else df
    d = d.select(F.concat(F.lit(">"), name, F.lit("\n"), seq).alias("value"))
    (d.repartition(files) if files else d).write.mode("overwrite").text(path)


def write_matrix(df: DataFrame, path: str, samples: list, feature: str = "feature", sample: str = "sample", value: str = "value") -> None:
    """A wide matrix, largest total first, compressed."""
    from ..operators.matrix import wide

    wide(df, feature, sample, value, samples).orderBy(F.desc("total"), feature).drop("total").write.mode("overwrite").csv(path, sep="\t", header=True, compression="gzip")


def nexus(df: DataFrame, name: str, seq: str) -> DataFrame:
    """One row: the alignment of one gene as NEXUS text; lengths must agree."""
    n = F.when(F.min(F.length(seq)) != F.max(F.length(seq)), F.raise_error(F.lit("sequences differ in length"))).otherwise(F.max(F.length(seq)))
    rows = F.array_join(F.array_sort(F.collect_list(F.concat(name, F.lit("\t"), seq))), "\n")
    return df.agg(F.count("*").alias("k"), n.alias("n"), rows.alias("rows")).select(F.concat(F.lit("#NEXUS\nBegin data;\nDimensions ntax="), "k", F.lit(" nchar="), "n", F.lit(";\nFormat datatype=dna missing=? gap=-;\nMatrix\n"), "rows", F.lit("\n;\nEnd;\n")).alias("value"))


def phylip(df: DataFrame, name: str, seq: str, width: int = 10) -> DataFrame:
    """One row: the alignment of one gene as PHYLIP text; names are cut to ``width``, and two equal ones or different lengths raise."""
    short = F.substring(name, 1, width)
    n = F.when(F.min(F.length(seq)) != F.max(F.length(seq)), F.raise_error(F.lit("sequences differ in length"))).otherwise(F.max(F.length(seq)))
    k = F.when(F.countDistinct(short) != F.count("*"), F.raise_error(F.lit("names are not unique when cut"))).otherwise(F.count("*"))
    rows = F.array_join(F.array_sort(F.collect_list(F.concat(F.rpad(short, width, " "), F.lit(" "), F.col(seq)))), "\n")
    return df.agg(k.alias("k"), n.alias("n"), rows.alias("rows")).select(F.concat("k", F.lit(" "), "n", F.lit("\n"), "rows", F.lit("\n")).alias("value"))


def write_tables(df: DataFrame, path: str, by: list[str]) -> None:
    """One folder of tab-separated files for each value of ``by``, compressed."""
    df.write.mode("overwrite").partitionBy(*by).csv(path, sep="\t", header=True, compression="gzip")


def write_groups(df: DataFrame, path: str, group: str, member: str, sep: str = ",") -> None:
    """A line a group: its name and its members, sorted and joined."""
    rows = df.groupBy(group).agg(F.array_join(F.array_sort(F.collect_set(F.col(member).cast("string"))), sep).alias("members"))
    rows.orderBy(group).write.mode("overwrite").csv(path, sep="\t", quote="", escape="")


def vcf_lines(variants: DataFrame) -> DataFrame:
    """value: VCF lines of contig, pos, ref, alt, headed by the format line and ordered by contig and place."""
    head = variants.sparkSession.createDataFrame([(0, "##fileformat=VCFv4.2"), (1, "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")], "o int, value string")
    body = variants.select(F.lit(2).alias("o"), F.concat_ws("\t", F.col("contig").cast("string"), F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"), F.lit(".")).alias("value"), F.col("contig").cast("string").alias("c"), F.col("pos").cast("long").alias("p"))
    return head.select("o", "value", F.lit(None).cast("string").alias("c"), F.col("o").cast("long").alias("p")).union(body).orderBy("o", "c", "p").select("value")


def consensus_records(seqs: DataFrame, contig: str, header: str, seq: str, width: int = 80) -> DataFrame:
    """value: a FASTA record a contig, its statistics header and its sequence in lines of ``width``."""
    lines = F.array_join(F.regexp_extract_all(seq, F.lit(f"(.{{1,{width}}})"), F.lit(1)), "\n")
    return seqs.orderBy(contig).select(F.concat(F.lit(">"), F.col(header), F.lit("\n"), lines).alias("value"))
