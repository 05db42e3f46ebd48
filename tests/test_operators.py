"""Hand-computed fixtures."""

import pytest
from pyspark.sql import functions as F

from granary.functions import sequence as seq
from granary.functions import stats
from granary.operators import assembly, bins, consensus, genes, hits, intervals, matrix, taxonomy


def one(spark, expr, **cols):
    return spark.createDataFrame([tuple(cols.values())], list(cols)).select(expr.alias("x")).first()["x"]


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("s,want", [("ACGTacg", "cgtACGT"), ("", ""), ("NNA", "TNN")])
def test_reverse_complement(spark, s, want):
    assert one(spark, seq.reverse_complement(F.col("s")), s=s) == want
    assert one(spark, seq.reverse_complement(seq.reverse_complement(F.col("s"), True), True), s=s) == s


@pytest.mark.parametrize("s,want", [("ATGTAANN", "M*"), ("ATGAA", "M"), ("AN", ""), ("ATGNNC", "MX"), ("", "")])
def test_translation(spark, s, want):
    assert one(spark, seq.translate_codons(F.col("s")), s=s) == want


def test_gc(spark):
    assert one(spark, seq.gc_percent(F.col("s")), s="GGCAT") == 60.0
    assert one(spark, seq.gc_percent(F.col("s")), s="nn") == -1.0
    assert one(spark, seq.gc3_percent(F.col("s")), s="AAGAAC") == 100.0
    assert one(spark, seq.gc3_percent(F.col("s")), s="AAGA") is None


def test_strings(spark):
    assert one(spark, seq.common_prefix(F.col("a"), F.col("b")), a="abcd", b="abxd") == "ab"
    assert one(spark, seq.cigar_length(F.col("c"), "HS"), c="5S90M3I2S") == 7
    assert one(spark, seq.pad_lineage(F.array(F.lit("a"), F.lit(" ")), 4), z=1) == ["a", "?", "?", "?"]
    assert one(spark, seq.known_depth(F.array(F.lit("a"), F.lit("?"))), z=1) == 1
    g = one(spark, seq.gene_id(F.col("s")), s="S1__C12_L=5000=_3")
    assert (g["sample"], g["contig"], g["length"], g["gene"]) == ("S1", "C12", 5000, 3)
    assert one(spark, seq.gene_id(F.col("s")), s="broken") is None
    assert one(spark, seq.pair_identity(F.col("a"), F.col("b")), a="AC-N", b="AG-A") == 50.0
    assert one(spark, seq.round_half_up(F.col("x"), 1), x=-0.25) == -0.2


@pytest.mark.parametrize("v,low,mid", [([1.0, 2.0, 9.0], 1.0, 2.0), ([5.0], 5.0, 5.0), ([], 1.0, None)])
def test_index_quantiles(spark, v, low, mid):
    df = spark.createDataFrame([(v,)], "v array<double>")
    r = df.select(stats.index_quantile(F.col("v"), 0.1).alias("a"), stats.index_quantile_rounded(F.col("v"), 0.5).alias("b")).first()
    assert (r["a"], r["b"]) == (low, mid)


def test_spearman_ties(spark):
    df = spark.createDataFrame([("g", 1.0, 1.0), ("g", 1.0, 2.0), ("g", 3.0, 3.0)], "g string, x double, y double")
    assert stats.spearman(df, ["g"], "x", "y").first()["rho"] == 0.875
    assert stats.pearson(df.withColumn("x", F.lit(1.0)), ["g"], "x", "y").first()["r"] == 0.0


def test_roll_up_keeps_sums(spark):
    df = spark.createDataFrame([(["a", "b"], "s", 2.0), (["a", "c"], "s", 3.0)], "l array<string>, sample string, v double")
    assert rows(matrix.roll_up(df, "l", "sample", "v"), "level", "feature", "value") == [(1, "a", 5.0), (2, "a;b", 2.0), (2, "a;c", 3.0)]


def test_normalize_and_wide(spark):
    df = spark.createDataFrame([("f", "s1", 1.0), ("g", "s1", 3.0), ("f", "s2", 0.0)], "feature string, sample string, value double")
    assert rows(matrix.normalize(df), "feature", "sample", "value") == [("f", "s1", 0.25), ("f", "s2", 0.0), ("g", "s1", 0.75)]
    assert rows(matrix.wide(df, "feature", "sample", "value", ["s1", "s2"]), "feature", "s1", "s2", "total") == [("f", 1.0, 0.0, 1.0), ("g", 3.0, 0.0, 3.0)]


def test_runs_emit_the_last(spark):
    df = spark.createDataFrame([("c", p, d) for p, d in enumerate([1, 1, 0, 0, 0, 2])], "c string, p int, d int")
    assert rows(intervals.runs(df, ["c"], ["p"], "d", F.col("p"), F.col("p")), "run", "d", "start", "end", "n") == [(1, 1, 0, 1, 2), (2, 0, 2, 4, 3), (3, 2, 5, 5, 1)]


def test_range_join_touches_ends(spark):
    p = spark.createDataFrame([("c", x) for x in (4, 5, 10, 11)], "k string, x int")
    r = spark.createDataFrame([("c", "g", 5, 10)], "k string, g string, s int, e int")
    assert rows(intervals.range_join(p, r, ["k"], "x", "s", "e", 3), "x") == [(5,), (10,)]


def test_n50_definitions(spark):
    df = spark.createDataFrame([("b", x) for x in (2, 2, 4)], "g string, len int")
    assert tuple(assembly.n_descending(df, "g", "len").first()) == ("b", 2, 2)
    assert tuple(assembly.n_ascending(df, "g", "len").first()) == ("b", 2)


def test_votes(spark):
    two = spark.createDataFrame([("r", ["k", "a"]), ("r", ["k", "b"])], "q string, l array<string>")
    assert rows(taxonomy.vote(two, "q", "l", 2, 0.9), "level", "name") == [(1, "k")]
    ten = spark.createDataFrame([("r", ["k", "a"])] * 9 + [("r", ["k", "b"])], "q string, l array<string>")
    assert rows(taxonomy.vote(ten, "q", "l", 2, 0.9), "level", "name") == [(1, "k"), (2, "k;a")]
    unknown = spark.createDataFrame([("r", ["?", "a"])], "q string, l array<string>")
    assert rows(taxonomy.vote(unknown, "q", "l", 2), "level") == []


def test_ambiguous_best_is_dropped(spark):
    df = spark.createDataFrame([("g", "c1", 5.0), ("g", "c2", 5.0), ("h", "c1", 5.0), ("h", "c2", 4.0)], "g string, c string, s double")
    assert rows(hits.drop_ambiguous(df, "g", "c", "s"), "g", "c") == [("h", "c1")]


def test_quality_at_thresholds(spark):
    df = spark.createDataFrame([("a", 50.0, 5.0), ("b", 50.1, 5.0), ("c", 90.0, 5.1), ("d", None, 1.0)], "bin string, compl double, conta double")
    assert rows(bins.quality(df, 50, 5), "bin") == [("b",)]
    assert rows(bins.quality(df, 50, 5, failing=True), "bin") == [("a",), ("c",), ("d",)]


def test_greedy_groups(spark):
    sets = {"a": (9.0, [1, 2, 3, 4, 5]), "b": (8.0, [1, 2, 3, 4, 5]), "c": (7.0, [6, 7]), "d": (6.0, [1, 6])}
    df = spark.createDataFrame([("x", n, i, s) for n, (s, it) in sets.items() for i in it], "block string, name string, item int, score double")
    assert rows(bins.greedy_groups(df, "block", "name", "item", "score"), "name", "kind") == [("a", "new"), ("b", "joined"), ("c", "new"), ("d", "ambiguous")]


def test_consensus(spark):
    df = spark.createDataFrame([("A", "G", 0, 0, 30), ("A", "G", 1, 2, 30), ("A", "G", 499, 501, 30), ("A", "G", 2, 2, 10)], "r string, a string, rn int, an int, q int")
    got = [r["x"] for r in df.select(consensus.call(F.col("r"), F.col("a"), F.col("rn"), F.col("an"), F.col("q")).alias("x")).collect()]
    assert got == ["N", "G", "A", "a"]


def test_empty_tables(spark):
    e = spark.createDataFrame([], "g string, len int")
    assert assembly.n_descending(e, "g", "len").count() == 0
    assert matrix.normalize(spark.createDataFrame([], "feature string, sample string, value double")).count() == 0


def test_codon_sites(spark):
    df = spark.createDataFrame([("g", "a", "TTTATGGAA"), ("g", "b", "TTCATGGAC"), ("g", "o", "AAAAAAAAA")], "gene string, species string, s string")
    assert rows(consensus.codon_sites(df, "gene", "species", "s", ["o"]), "codon", "kind") == [(1, "synonymous"), (2, "constant"), (3, "nonsynonymous")]


def test_filled_consensus_and_score(spark):
    df = spark.createDataFrame([("c", 2, "A", 6), ("c", 4, "g", 6), ("c", 9, "T", 6)], "contig string, pos int, base string, len int")
    assert rows(consensus.fill_consensus(df, "contig", "len"), "seq") == [("nAngnn",)]
    f = spark.createDataFrame([([0.1, 0.5, 0.5, 0.9, 1.0],)], "f array<double>")
    assert f.select(consensus.conspecific_score(F.col("f"), F.lit(100)).alias("x")).first()["x"] == 120.0


def test_reads_and_contigs(spark):
    r = lambda s, q: one(spark, genes.read_passes(F.col("s"), F.col("q"), least=4, homopolymer=3), s=s, q=q)
    assert r("ACGTA", "IIIII") and not r("ACG", "III") and not r("ACGTA", "!!!!!") and not r("AAAAC", "IIIII") and not r("NNNAC", "IIIII")
    a = spark.createDataFrame([("r", "AC", "AB")], "id string, seq string, qual string")
    assert tuple(genes.interleave(a, a).first()) == ("r", "ACNGT", "AB!BA")
    c = spark.createDataFrame([("c", "ACGTA", 2.4)], "id string, seq string, cov double")
    assert rows(genes.replicate_by_coverage(c, "cov", 3, 5), "copy", "start", "seq") == [(1, 1, "ACG"), (1, 4, "TA"), (2, 1, "ACG"), (2, 4, "TA")]


def test_resistance_hits(spark):
    h = spark.createDataFrame([("q", "s", 1e-9, 91.0), ("q", "t", 1e-9, 50.0), ("p", "s", 1e-3, 99.0)], "query string, subject string, evalue double, pident double")
    s = spark.createDataFrame([("s", 90.0, "c1", "d1"), ("s", 95.0, "c2", "d1"), ("t", 90.0, "c3", "d3")], "subject string, min_id double, class string, drug string")
    assert rows(genes.resistance_hits(h, s), "query", "classes", "drugs") == [("q", "c1,c2", "d1")]


def test_missing_cluster_raises(spark):
    g, i = spark.createDataFrame([("a",)], "m string"), spark.createDataFrame([("b", 1)], "m string, cluster int")
    with pytest.raises(Exception, match="no cluster for a"):
        genes.to_clusters(g, i, "m").collect()
    assert genes.to_clusters(g, i, "m", strict=False).count() == 0


def plain_fold(rows, better):
    """The ordered fold in plain Python."""
    best, ever = rows[0], rows[0][0]
    for x in rows[1:]:
        if better(x, best, ever):
            best, ever = x, max(ever, x[0])
    return best


def test_convincing_hit_and_best_identity(spark):
    import random

    from granary.operators import selection

    rng = random.Random(4)
    rows = [(q, s, rng.choice([80.0, 84.0, 90.0, 93.0, 99.0]), rng.randrange(50, 200), 1e-9, float(rng.randrange(100, 300))) for q in range(60) for s in range(rng.randrange(1, 9))]
    hits = spark.createDataFrame(rows, "query int, subject int, pident double, aln_len int, evalue double, bitscore double")
    convincing = lambda x, b, ever: x[0] > b[0] - 5 and ((x[0] >= b[0] * 0.97 and x[0] >= ever * 0.9 and x[1] >= b[1] * 1.15) or (x[0] >= b[0] * 1.03 and x[1] >= b[1] * 0.9) or x[2] > b[2] * 0.8)
    longer = lambda x, b, _: (x[0] > b[0] and x[1] > b[1]) or (x[1] > b[1] * 1.4 and x[0] > b[0] * 0.9)
    want, held = {}, {}
    for q in range(60):
        own = [r for r in rows if r[0] == q]
        want[q] = plain_fold([(r[2], r[3], r[5], r[1]) for r in sorted(own, key=lambda r: (-r[5], r[4], r[1]))], convincing)
        held[q] = plain_fold([(r[2], r[3]) for r in sorted(own, key=lambda r: r[1])], longer)
    got = {r["query"]: (r["pident"], r["aln_len"], r["bitscore"], r["subject"]) for r in selection.fold_convincing(hits, "query").collect()}
    assert got == want
    assert {r["query"]: (r["pident"], r["aln_len"]) for r in selection.best_identity(hits, "query", "subject").collect()} == held


def test_consensus_header_and_submatrix_files(spark, tmp_path):
    from granary.operators import annotation, reports

    h = spark.createDataFrame([("c1", 10, 2, 1), ("c2", 5, 0, 0)], "c string, a int, b int, d int").select(reports.consensus_header(F.col("c"), F.col("a"), F.col("b"), F.col("d")).alias("h"))
    assert [r["h"] for r in h.collect()] == ["c1 COV=10 REPL=2 CONFL=1", "c2 COV=5 REPL=0 CONFL=0"]
    assert tuple(reports.consensus_totals(h, "h").first()) == (2, 15, 2)
    m = spark.createDataFrame([("f", "s", 1.0), ("g", "s", 2.0)], "feature string, sample string, value double")
    members = spark.createDataFrame([("f", "a"), ("g", "a"), ("g", "b")], "feature string, g string")
    annotation.submatrices(m, members).write.partitionBy("g").parquet(f"{tmp_path}/sub")
    assert spark.read.parquet(f"{tmp_path}/sub/g=b").count() == 1 and spark.read.parquet(f"{tmp_path}/sub/g=a").count() == 2


def test_tiered_groups(spark):
    sets = {"a": "1234", "b": "1234", "c": "5678", "d": "1256", "e": "123x", "f": "wyz9", "low": "1234"}
    members = spark.createDataFrame([(1, n, i) for n, items in sets.items() for i in items], "block int, name string, item string")
    quality = spark.createDataFrame([(1, "a", 99.0, 0.0, 0.99), (1, "b", 96.0, 2.0, 0.96), (1, "c", 99.0, 0.5, 0.98), (1, "d", 98.0, 1.0, 0.97), (1, "e", 81.0, 5.0, 0.93), (1, "f", 61.0, 9.0, 0.9), (1, "low", 59.0, 0.0, 1.0)], "block int, name string, compl double, conta double, agreement double")
    got = {r["name"]: (r["cluster"], r["tier"], r["kind"]) for r in bins.tiered_groups(members, quality, "block", "name", "item").collect()}
    # e shares 3 of 4 items with a: 0.75 is below every round's share.
    assert got == {"a": ("a", 0, "new"), "b": ("a", 1, "joined"), "c": ("c", 0, "new"), "d": (None, 0, "ambiguous"), "e": (None, 2, "ambiguous"), "f": ("f", 3, "new")}


def test_greedy_groups(spark):
    sets = [("a", 9.0, "1234"), ("b", 8.0, "1234x"), ("c", 7.0, "1256"), ("d", 6.0, "789")]
    rows = [(1, n, i, s) for n, s, items in sets for i in items]
    got = {r["name"]: (r["cluster"], r["kind"]) for r in bins.greedy_groups(spark.createDataFrame(rows, "block int, name string, item string, score double"), "block", "name", "item", "score").collect()}
    assert got == {"a": ("a", "new"), "b": ("a", "joined"), "c": (None, "ambiguous"), "d": ("d", "new")}


def test_canopies_and_multi_copy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.random((4, 12)) * 10
    rows = [(1, i * 10 + j, [float(x) for x in base[i] * (1 + j) + rng.random(12) * 0.01]) for i in range(4) for j in range(5)]
    got = {r["name"]: r["canopy"] for r in bins.canopies(spark.createDataFrame(rows, "block int, name int, v array<double>"), "block", "name", "v", 0.05).collect()}
    want, centres = {}, []
    for _, n, v in sorted(rows, key=lambda r: (-sum(r[2]), r[1])):
        near = [c for c, w in centres if 1 - np.corrcoef(v, w)[0, 1] <= 0.05]
        if not near:
            centres.append((n, v))
        want[n] = near[0] if near else n
    assert got == want and len(set(want.values())) == 4
    genes = [("s", f"c{i}", i, [float(x) for x in base[0] + rng.random(12) * 0.1]) for i in range(5)] + [("s", "m", 10, [float(x) for x in base[1]]), ("s", "m", 11, [float(x) for x in base[0] * 2])]
    got = {r["category"]: r["item"] for r in bins.resolve_multi_copy(spark.createDataFrame(genes, "g string, category string, item int, v array<double>"), "g", "category", "item", "v").collect()}
    assert got == {f"c{i}": i for i in range(5)} | {"m": 11}


def test_similar_groups(spark):
    import random

    from granary.operators import similarity

    rng = random.Random(1)
    base = ["".join(rng.choice("ACGT") for _ in range(400)) for _ in range(6)]
    rows = [(i, s) for i, s in enumerate(base)] + [(100 + i, s[:200] + "A" + s[201:390]) for i, s in enumerate(base)] + [(200, "ACG"), (201, base[0][:60] + base[1][:340])]
    got = {r["id"]: r["representative"] for r in similarity.similar_groups(spark.createDataFrame(rows, "id int, seq string"), "id", "seq").collect()}
    assert got == {i: i for i in range(6)} | {100 + i: i for i in range(6)} | {200: 200, 201: got[201]} and got[201] in (1, 201)


@pytest.mark.parametrize("s,k", [("ACGTACGTNACG" * 60, 4), ("AC", 4), ("ACGT", 4)])
def test_kmer_counts(spark, s, k):
    import collections

    want = collections.Counter(s[i : i + k] for i in range(len(s) - k + 1))
    df = spark.createDataFrame([("x", s)], "g string, s string")
    assert {r["kmer"]: r["n"] for r in seq.kmer_counts(df, "g", "s", k, size=16).collect()} == dict(want)
    assert seq.kmer_table(df, "g", "s", k).count() == 256
    assert seq.kmer_table(df, "g", "s", k, least=1000).count() == 0


def test_fourfold_sites(spark):
    m = spark.createDataFrame([("g", "a", "GCTATGTTA"), ("g", "b", "GCAATGTTG"), ("g", "o", "TTTTTTTTT")], "gene string, sp string, s string")
    got = {r["codon"]: (r["kind"], r["fourfold"]) for r in consensus.codon_sites(m, "gene", "sp", "s", ["o"]).collect()}
    assert got == {1: ("synonymous", True), 2: ("constant", False), 3: ("synonymous", False)}
    assert {r["sp"]: r["seq"] for r in consensus.fourfold_alignment(m, "gene", "sp", "s", ["o"]).collect()} == {"a": "T", "b": "A", "o": "T"}


def test_common_prefix_and_identity(spark):
    assert one(spark, seq.common_prefix(F.col("a"), F.col("b")), a="abcd", b="abx") == "ab" and one(spark, seq.common_prefix(F.col("a"), F.col("b")), a="ab", b="ab") == "ab"
    assert one(spark, seq.pair_identity(F.col("a"), F.col("b")), a="AC-GN", b="ACTGG") == 100.0 and one(spark, seq.pair_identity(F.col("a"), F.col("b")), a="--", b="AC") is None
