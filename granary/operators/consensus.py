"""Consensus calls and columns of alignments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def call(ref: Column, alt: Column, ref_n: Column, alt_n: Column, qual: Column, freq: float = 0.501, depth: int = 1) -> Column:
    """N without reads; the alternative above freq and depth; lower case where quality is 20 or less or depth 30000 or more."""
    n = ref_n + alt_n
    base = F.when((alt_n / F.greatest(n, F.lit(1)) > freq) & (n > depth), alt).otherwise(ref)
    return F.when(n < 1, "N").when((qual > 20) & (n < 30000), F.upper(base)).otherwise(F.lower(base))


def resolve_positions(df: DataFrame, key: list[str], quality: str, allele: str) -> DataFrame:
    """One row a position: the highest quality (ties to the smaller allele), with how many further rows disagree."""
    w = W.partitionBy(*key)
    r = df.withColumn("_n", F.row_number().over(w.orderBy(F.desc(quality), allele))).withColumn("_first", F.first(allele).over(w.orderBy(F.desc(quality), allele)))
    conflicts = F.sum(F.when(F.col(allele) != F.col("_first"), 1).otherwise(0)).over(w)
    return r.withColumn("conflicts", conflicts).where("_n = 1").drop("_n", "_first")


def frequency_histogram(df: DataFrame, alt_n: str, ref_n: str) -> DataFrame:
    """percent (int(100 f)), n of positions with reads."""
    t = F.col(alt_n) + F.col(ref_n)
    return df.where(t > 0).groupBy(F.floor(100 * F.col(alt_n) / t).alias("percent")).agg(F.count("*").alias("n"))


def columns(msa: DataFrame, gene: str, species: str, seq: str) -> DataFrame:
    """gene, species, pos (from 1), base."""
    return msa.select(gene, species, F.posexplode(F.split(F.upper(seq), "")).alias("pos", "base")).withColumn("pos", F.col("pos") + 1).where("base != ''")


#: Letters of a sequence that move as one row: whole codons.
PIECE = 63
#: The same for columns: at four bytes a letter, what a bitmap aggregate of Spark holds (4096 bytes).
WIDE_PIECE = 1024
#: Letters that tell nothing of a column, and letters that an AND passes by as an OR does the zero letter: in planes 0 to 15, and in plane 16.
UNKNOWN, ALL_BITS = "-N?", ("\U000fffff", "\U0010ffff")


def _pieces(msa: DataFrame, gene: str, seq: str, *also: str, size: int = PIECE) -> DataFrame:
    """gene, also, _at (letters before the piece) and _piece of the upper-case sequences, dealt by gene and piece: letters and codons are told apart only where all
    rows of theirs have met, so what moves is the sequences themselves."""
    cut = F.regexp_extract_all(F.upper(F.col(seq)), F.lit(f"(?s)(.{{1,{size}}})"), F.lit(1))
    return msa.select(gene, *also, F.posexplode(cut).alias("_k", "_piece")).select(gene, *also, (F.col("_k") * size).alias("_at"), "_piece").repartition(gene, "_at")


def _varying(pieces: DataFrame, gene: str, species: str) -> DataFrame:
    """gene, _at, _mask: of pieces that are not all equal, which columns are variable (maybe none). Known letters of a column are equal if their codes' AND is
    their OR, with the one or the other letter in place of unknown ones.

    Letters do not become rows: codes of four bytes are joined as bitmaps. The species are in the comparison of pieces so that this reads the same columns as the
    join with its result and both share one exchange.
    """
    known = lambda to: reduce(lambda s, x: F.replace(s, F.lit(x), F.lit(to)), UNKNOWN, F.col("_piece"))
    code = lambda s: F.encode(s, "UTF-32")
    low, high, n = F.min(F.struct("_piece", species)).alias("_low"), F.max(F.struct("_piece", species)).alias("_high"), F.max(F.length("_piece")).alias("_n")
    any_ = F.bitmap_or_agg(code(known("\0"))).alias("_or")
    alls = [F.bitmap_and_agg(code(F.rpad(known(x), WIDE_PIECE, x))).alias(f"_and{k}") for k, x in enumerate(ALL_BITS)]
    x = pieces.groupBy(gene, "_at").agg(low, high, n, any_, *alls).where(F.col("_low._piece") != F.col("_high._piece"))
    at = lambda bits, i: F.substring(bits, 4 * i + 1, F.lit(4))
    differ = lambda i: (at("_or", i) != at("_and0", i)) & (at("_or", i) != at("_and1", i)) & (at("_or", i) != F.lit(bytes(4)))
    mask = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), differ)
    return x.select(gene, "_at", mask.alias("_mask"))


def variable_columns(msa: DataFrame, gene: str, species: str, seq: str) -> DataFrame:
    """gene, species, positions, seq: the alignment reduced to columns with two or more known bases. Pieces of sequences meet by gene and place, are reduced there and
    put together by gene and species."""
    p = _pieces(msa, gene, seq, species, size=WIDE_PIECE).where("_piece is not null")  # none is; else the join below asks this of one side, and no exchange is shared
    # A condition on the letters kept, or on the mask alone, would be pushed down and make each of them twice.
    x = p.join(_varying(p, gene, species), [gene, "_at"]).where(F.length("_piece") >= F.nullif(F.array_position("_mask", True), F.lit(0)))
    here = F.filter(F.transform("_mask", lambda b, i: F.when(b & (i < F.length("_piece")), F.col("_at") + i + 1)), lambda i: i.isNotNull())
    x = x.select(gene, species, "_at", F.array_join(F.filter(F.split("_piece", ""), lambda c, i: F.get("_mask", i)), "").alias("_s"), here.alias("_p"))
    s = x.groupBy(gene, species).agg(F.array_sort(F.collect_list(F.struct("_at", "_s"))).alias("_x"), F.collect_list("_p").alias("_p"))
    # Rows of one gene and species are one row, as everywhere here; usually there is one. Several have their letters in order of place and letter.
    places = F.array_distinct(F.transform("_x", lambda e: e["_at"]))
    letters = lambda at: F.transform(F.filter("_x", lambda e: e["_at"] == at), lambda e: F.split(e["_s"], ""))
    column = lambda rows, i: F.array_sort(F.filter(F.transform(rows, lambda r: F.get(r, i)), lambda c: c.isNotNull()))
    widest = lambda rows: F.array_max(F.transform(rows, F.size))
    merged = F.flatten(F.transform(F.transform(places, letters), lambda rows: F.flatten(F.transform(F.sequence(F.lit(0), widest(rows) - 1), lambda i: column(rows, i)))))
    plain = F.transform("_x", lambda e: e["_s"])
    return s.select(gene, species, F.array_sort(F.flatten("_p")).alias("positions"), F.array_join(F.when(F.size(places) == F.size("_x"), plain).otherwise(merged), "").alias("seq"))


def watterson(msa: DataFrame, gene: str, species: str, seq: str) -> DataFrame:
    """gene, n, segregating, theta: variable columns over the harmonic number of n - 1."""
    c = columns(msa, gene, species, seq).where(~F.col("base").isin("-", "N", "?"))
    n = msa.groupBy(gene).agg(F.count("*").alias("n"))
    s = c.groupBy(gene, "pos").agg(F.min("base").alias("lo"), F.max("base").alias("hi")).groupBy(gene).agg(F.count_if(F.expr("lo != hi")).alias("segregating"))
    a = F.aggregate(F.sequence(F.lit(1), F.greatest(F.col("n") - 1, F.lit(1))), F.lit(0.0), lambda x, i: x + 1.0 / i)
    return n.join(s, gene, "left").select(gene, "n", F.coalesce("segregating", F.lit(0)).alias("segregating"), F.round(F.coalesce("segregating", F.lit(0)) / a, 6).alias("theta"))


def merge_identities(pairs: DataFrame, a: str, b: str, identity: str, length: str) -> DataFrame:
    """Identity of each pair over genes, weighted by length."""
    return pairs.groupBy(a, b).agg((F.sum(F.col(identity) * F.col(length)) / F.sum(length)).alias(identity))


def codon_sites(msa: DataFrame, gene: str, species: str, seq: str, outgroup: list | None = None) -> DataFrame:
    """gene, codon (from 1), kind (constant, synonymous or nonsynonymous) and fourfold over the species' known codons; outgroup ignored, gaps and Ns tolerated.

    A site is fourfold if its codons share their first two bases and any third one gives the same amino acid.
    """
    from ..functions.sequence import BASES, codon_table

    # A site's codons are the bits of one long: 4 * head + third base, heads being the first two bases.
    table, names = codon_table(), [a + b + c for a in BASES for b in BASES for c in BASES]
    codes = F.create_map(*[F.lit(x) for i, c in enumerate(names) for x in (c, i)])
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    masks = [signed(sum(1 << i for i, c in enumerate(names) if table[c] == aa)) for aa in sorted(set(table.values()))]
    free = [signed(~(15 << 4 * h) & (1 << 64) - 1) for h in range(16) if len({table[c] for c in names[4 * h : 4 * h + 4]}) == 1]
    m = msa if not outgroup else msa.where(~F.col(species).isin(outgroup))
    c = _pieces(m, gene, seq).select(gene, "_at", F.posexplode(F.regexp_extract_all("_piece", F.lit("(...)"), F.lit(1))).alias("i", "codon"))
    c = c.select(gene, "_at", "i", F.try_element_at(codes, F.col("codon")).alias("code")).where("code is not null")
    n = c.groupBy(gene, "_at", "i").agg(F.bit_or(F.expr("shiftleft(1L, code)")).alias("m"))
    several = sum((F.when(F.col("m").bitwiseAND(F.lit(a)) != 0, 1).otherwise(0) for a in masks), F.lit(0))
    kind = F.when(F.bit_count("m") == 1, "constant").when(several == 1, "synonymous").otherwise("nonsynonymous")
    fourfold = reduce(Column.__or__, [F.col("m").bitwiseAND(F.lit(f)) == 0 for f in free])
    return n.select(gene, (F.col("_at") / 3 + F.col("i") + 1).cast("int").alias("codon"), kind.alias("kind"), fourfold.alias("fourfold"))


def fourfold_alignment(msa: DataFrame, gene: str, species: str, seq: str, outgroup: list | None = None) -> DataFrame:
    """gene, species, seq: the third bases of the fourfold sites, in place order; species without any site are left out."""
    sites = codon_sites(msa, gene, species, seq, outgroup).where("fourfold").select(gene, "codon")
    c = msa.select(gene, species, F.posexplode(F.regexp_extract_all(F.upper(F.col(seq)), F.lit("(...)"), F.lit(1))).alias("i", "c")).withColumn("codon", F.col("i") + 1)
    got = c.join(sites, [gene, "codon"]).groupBy(gene, species).agg(F.array_sort(F.collect_list(F.struct("codon", F.substring("c", 3, 1).alias("base")))).alias("x"))
    return got.select(gene, species, F.array_join(F.transform("x", lambda e: e["base"]), "").alias("seq"))


def fill_consensus(calls: DataFrame, contig: str, length: str, gap: str = "n") -> DataFrame:
    """contig, seq: called bases (pos from 1, base) in place, gap elsewhere; positions beyond length are left out."""
    pieces = calls.where(f"pos between 1 and {length}").groupBy(contig, F.col(length).alias("_n")).agg(F.array_sort(F.collect_list(F.struct("pos", "base"))).alias("x"))
    # Between two calls a repeat fills the gap, so the work follows the calls and not the map of every place.
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("s"))
    built = F.aggregate("x", start, lambda a, e: F.struct(e["pos"].cast("int").alias("at"), F.concat(a["s"], F.repeat(F.lit(gap), e["pos"].cast("int") - a["at"] - 1), e["base"]).alias("s")))
    return pieces.select(contig, F.concat(built["s"], F.repeat(F.lit(gap), (F.col("_n") - built["at"]).cast("int"))).alias("seq"))


def conspecific_score(freqs: Column, bases: Column, below: float = 0.8, low: int = 20, high: int = 80) -> Column:
    """Share of alternative frequencies below ``below`` times the percentage of frequencies between low and high percent, by 100 over the sequence's bases."""
    mid = F.size(F.filter(freqs, lambda f: (f * 100 >= low) & (f * 100 < high)))
    few = F.size(F.filter(freqs, lambda f: f < below))
    return F.when((F.size(freqs) >= 5) & (bases > 0), few * (100.0 * mid / F.size(freqs)) * 100.0 / bases).otherwise(0.0)


def merge_variants(a: DataFrame, b: DataFrame) -> DataFrame:
    """chrom, pos, alts, qual: both tables' variants by position, alleles in order, highest quality."""
    u = a.select("chrom", "pos", "alt", "qual").unionByName(b.select("chrom", "pos", "alt", "qual"))
    return u.groupBy("chrom", "pos").agg(F.array_join(F.sort_array(F.collect_set("alt")), ",").alias("alts"), F.max("qual").alias("qual"))
