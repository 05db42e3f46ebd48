"""Scalar functions on sequences, identifiers and lineages, as column expressions (null in, null out)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Complements of the nucleotide codes and of the IUPAC codes.
DNA, DNA_COMPLEMENT = "ACGTacgt", "TGCAtgca"
IUPAC, IUPAC_COMPLEMENT = "ACGTUMRWSYKVHDBNacgtumrwsykvhdbn", "TGCAAKYWSRMBDHVNtgcaakywsrmbdhvn"
# Amino acids of the standard code, codons in TCAG order.
BASES, AMINO_ACIDS = "TCAG", "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def codon_table() -> dict[str, str]:
    return {a + b + c: AMINO_ACIDS[16 * i + 4 * j + k] for i, a in enumerate(BASES) for j, b in enumerate(BASES) for k, c in enumerate(BASES)}


def reverse_complement(s: Column, iupac: bool = False) -> Column:
    return F.translate(F.reverse(s), IUPAC if iupac else DNA, IUPAC_COMPLEMENT if iupac else DNA_COMPLEMENT)


def _each_place(s: Column, size: Column, of) -> Column:
    """of(characters, i) for i from 0 to size - 1. The characters are split once and bound to a name; substring() by place would walk a long text again and again."""
    chars = F.array(F.slice(F.split(s, ""), F.lit(1), F.greatest(F.length(s), F.lit(1))))
    return F.get(F.transform(chars, lambda c: F.transform(F.sequence(F.lit(0), size - 1), lambda i: of(c, i))), F.lit(0))


def translate_codons(s: Column) -> Column:
    """Trailing Ns and bases beyond a multiple of three are dropped; unknown codons become X."""
    t = F.regexp_replace(F.upper(s), "N+$", "")
    codes = F.create_map(*[F.lit(x) for kv in sorted(codon_table().items()) for x in kv])
    n = F.floor(F.length(t) / 3).cast("int")
    each = _each_place(t, n, lambda c, i: F.coalesce(F.try_element_at(codes, F.array_join(F.slice(c, i * 3 + 1, F.lit(3)), "")), F.lit("X")))
    return F.when(s.isNull(), None).when(n < 1, "").otherwise(F.array_join(each, ""))


def count_of(s: Column, letters: str) -> Column:
    return F.length(s) - F.length(F.translate(s, letters, ""))


def gc_percent(s: Column) -> Column:
    """Upper-case bases only, three decimals; -1 without any."""
    gc, at = count_of(s, "GC"), count_of(s, "AT")
    return F.when(gc + at == 0, F.lit(-1.0)).otherwise(F.round(100.0 * gc / (gc + at), 3))


def every_third(s: Column) -> Column:
    n = F.floor(F.length(s) / 3).cast("int")
    return F.when(n < 1, "").otherwise(F.array_join(_each_place(s, n, lambda c, i: F.get(c, i * 3 + 2)), ""))


def gc3_percent(s: Column) -> Column:
    """GC of third codon bases; null where the length is no multiple of three."""
    return F.when(F.length(s) % 3 == 0, gc_percent(every_third(s)))


def kmer_counts(df: DataFrame, by: str, seq: str, k: int, size: int = 256) -> DataFrame:
    """by, kmer, n: every window of k letters. A sequence is cut once into chunks that overlap by k - 1, so no place is reached by walking a long text."""
    cut = df.where(F.length(seq) >= k).select(by, F.regexp_extract_all(seq, F.lit(f"(?s)(.{{1,{size}}})"), F.lit(1)).alias("_c"))
    tail = F.slice("_c", F.lit(2), F.greatest(F.size("_c"), F.lit(1)))
    parts = cut.select(by, F.explode(F.zip_with("_c", tail, lambda a, b: F.concat(a, F.substring(F.coalesce(b, F.lit("")), 1, k - 1)))).alias("_p")).where(F.length("_p") >= k)
    each = parts.select(by, "_p", F.explode(F.sequence(F.lit(1), F.length("_p") - k + 1)).alias("_i"))
    return each.groupBy(by, F.substring("_p", F.col("_i"), F.lit(k)).alias("kmer")).agg(F.count("*").alias("n"))


def kmer_table(df: DataFrame, by: str, seq: str, k: int = 4, least: int = 0) -> DataFrame:
    """by, kmer, n for all 4^k k-mers (0 where absent): windows of both strands of sequences of at least ``least`` letters; windows with other letters do not count."""
    from itertools import product

    long = df.where(F.length(seq) >= least)
    n = kmer_counts(long, by, seq, k).where(f"kmer rlike '^[ACGT]{{{k}}}$'")
    both = n.union(n.select(by, reverse_complement(F.col("kmer")), "n")).groupBy(by, "kmer").agg(F.sum("n").alias("n"))
    every = F.split(F.lit(",".join("".join(x) for x in product("ACGT", repeat=k))), ",")  # 4^k names
    return long.select(by).distinct().select(by, F.explode(every).alias("kmer")).join(both, [by, "kmer"], "left").fillna(0, ["n"])


def chunks(s: Column, size: int) -> Column:
    """Structs start, end (from 1, inclusive) and seq of fixed chunks."""
    n = F.length(s)
    each = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(size)), lambda i: F.struct(i.alias("start"), F.least(i + size - 1, n).alias("end"), F.substring(s, i, F.lit(size)).alias("seq")))
    return F.when(n > 0, each)


def common_prefix(a: Column, b: Column) -> Column:
    same = F.array_position(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False)).cast("int")), 0)
    return F.when(a == b, a).otherwise(F.substring(a, F.lit(1), (same - 1).cast("int")))


def is_integer(s: Column) -> Column:
    return s.rlike(r"^[+-]?\d+$")


def round_half_up(x: Column, digits: int) -> Column:
    """Half up towards plus infinity, by scaling."""
    f = float(10**digits)
    return F.floor(x * f + 0.5) / f


def gene_id(raw: Column) -> Column:
    """``sample__C<contig>_L=<length>=_<gene>`` as a struct; null where malformed."""
    p = r"^(.+?)__(C\d+)_L=(\d+)=_(\d+)$"
    parts = F.struct(F.regexp_extract(raw, p, 1).alias("sample"), F.regexp_extract(raw, p, 2).alias("contig"), F.expr("0").alias("_"))
    return F.when(raw.rlike(p), F.struct(parts["sample"].alias("sample"), parts["contig"].alias("contig"), F.regexp_extract(raw, p, 3).try_cast("int").alias("length"), F.regexp_extract(raw, p, 4).try_cast("int").alias("gene")))


def pad_lineage(ranks: Column, depth: int) -> Column:
    """Blanks become ``?``, missing ranks are padded, what is beyond depth is cut."""
    named = F.transform(F.coalesce(ranks, F.array().cast("array<string>")), lambda x: F.when(x.isNull() | (F.trim(x) == ""), "?").otherwise(x))
    return F.slice(F.concat(named, F.array_repeat(F.lit("?"), depth)), 1, depth)


def known_depth(ranks: Column) -> Column:
    """Ranks before the first ``?``."""
    at = F.array_position(ranks, "?")
    return F.when(at == 0, F.size(ranks)).otherwise(at.cast("int") - 1)


def lineage_prefixes(ranks: Column, sep: str = ";") -> Column:
    """Structs level (from 1) and name of every prefix."""
    return F.transform(F.sequence(F.lit(1), F.size(ranks)), lambda i: F.struct(i.alias("level"), F.array_join(F.slice(ranks, F.lit(1), i), sep).alias("name")))


def cigar_length(cigar: Column, codes: str) -> Column:
    """Sum of the lengths of these CIGAR operations."""
    found = F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{codes}]"), F.lit(1))
    return F.aggregate(found, F.lit(0), lambda a, x: a + x.cast("int"))


def sum_list(s: Column, sep: str = ",") -> Column:
    return F.aggregate(F.split(s, sep), F.lit(0.0), lambda a, x: a + F.coalesce(x.try_cast("double"), F.lit(0.0)))


def newick_safe(name: Column, width: int = 40) -> Column:
    return F.regexp_replace(F.substring(name, 1, width), r"[\s:;,()\[\]']", "|")


def pair_identity(a: Column, b: Column, skip: str = "-N") -> Column:
    """Identical columns in percent over those where neither is a gap or unknown; null without any. Both are split once."""
    known = lambda x: F.coalesce((x != "") & ~x.isin(*skip), F.lit(False))
    columns = F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(known(x) & known(y), x == y)), lambda x: x.isNotNull())
    return F.when(F.size(columns) > 0, 100.0 * F.size(F.filter(columns, lambda x: x)) / F.size(columns))


def unique_names(df: DataFrame, name: str, order: str) -> DataFrame:
    """df with equal names told apart: the second and later ones, by order, get _2, _3 and so on. Names are few of a kind; each kind is numbered apart."""
    from pyspark.sql import Window as W

    n = F.row_number().over(W.partitionBy(name).orderBy(order))
    return df.withColumn(name, F.when(n > 1, F.concat(F.col(name), F.lit("_"), n.cast("string"))).otherwise(F.col(name)))
