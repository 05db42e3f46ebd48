import pytest

from granary.sources import formats as fmt


def put(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_fasta_round_trip(spark, tmp_path):
    p = put(tmp_path, "a.fa", ">s1 first\nAC\nGT\n>s2\n>s3\nNNn\n")
    got = {r["id"]: r["seq"] for r in fmt.read_fasta(spark, p, " ").collect()}
    assert got == {"s1": "ACGT", "s2": "", "s3": "NNn"}
    assert sorted(r["id"] for r in fmt.read_fasta_headers(spark, p).collect()) == ["s1 first", "s2", "s3"]
    out = str(tmp_path / "out")
    fmt.write_fasta(fmt.read_fasta(spark, p, " ").where("seq != ''"), out, files=2)
    assert {r["id"]: r["seq"] for r in fmt.read_fasta(spark, out).collect()} == {"s1": "ACGT", "s3": "NNn"}


def test_fastq(spark, tmp_path):
    p = put(tmp_path, "a.fq", "@r1\nACGT\n+\n@III\n@r2\nA\n+\nI\n")
    assert [(r["id"], r["seq"], r["qual"]) for r in fmt.read_fastq(spark, p).collect()] == [("r1", "ACGT", "@III"), ("r2", "A", "I")]


def test_gff(spark, tmp_path):
    r = fmt.read_gff(spark, put(tmp_path, "a.gff", "##gff\nc1\tp\tCDS\t3\t90\t.\t-\t0\tID=1_2;partial=01;\n")).first()
    assert (r["gene"], r["partial"], r["start"], r["end"], r["strand"]) == (">c1_2", "01", 3, 90, "-")


def test_sam_filter(spark, tmp_path):
    row = "{q}\t{f}\tc\t1\t{m}\t{c}\t*\t0\t0\t{s}\t*\tNM:i:{nm}\n"
    s = "A" * 100
    text = "@HD\n" + row.format(q="ok", f=0, m=30, c="100M", s=s, nm=5) + row.format(q="bad", f=0, m=30, c="100M", s=s, nm=6) + row.format(q="low", f=0, m=10, c="100M", s=s, nm=0) + row.format(q="clip", f=0, m=30, c="5S90M5S", s=s, nm=0) + row.format(q="un", f=4, m=0, c="*", s=s, nm=0)
    got = fmt.alignment_passes(fmt.read_sam(spark, put(tmp_path, "a.sam", text)))
    assert sorted(r["qname"] for r in got.collect()) == ["ok", "un"]


def test_vcf_m8_clusters(spark, tmp_path):
    v = fmt.read_vcf(spark, put(tmp_path, "a.vcf", "#x\nc\t5\t.\tA\tG\t40\t.\tDP=3;AF=1\tGT:AD\t1:2\n")).first()
    assert (v["pos"], v["qual"], v["info"]["DP"], v["fmt"]["AD"]) == (5, 40.0, "3", "2")
    m = fmt.read_m8(spark, put(tmp_path, "a.m8", "q\ts\t99.5\t100\t1\t0\t1\t100\t1\t100\t1e-9\t180\n")).first()
    assert (m["pident"], m["evalue"], m["bitscore"]) == (99.5, 1e-9, 180.0)
    c = fmt.read_clusters(spark, put(tmp_path, "a.idx", "#c\n1\t>a,>b\n2\t>c\n"))
    assert sorted((r["cluster"], r["member"]) for r in c.collect()) == [(1, "a"), (1, "b"), (2, "c")]
    b = fmt.read_cluster_blocks(spark, put(tmp_path, "a.clstr", ">Cluster 0\n0\t9nt, >x... *\n1\t9nt, >y... at +/99.1%\n>Cluster 1\n0\t5nt, >z... *\n"))
    assert sorted((r["cluster"], r["member"], r["representative"], r["identity"]) for r in b.collect()) == [(0, "x", True, None), (0, "y", False, 99.1), (1, "z", True, None)]


def test_matrix_and_map(spark, tmp_path):
    p = put(tmp_path, "m.tsv", "f\ts1\ts2\na\t1\t2\nb\t3\t\n")
    keep = spark.createDataFrame([("a",)], "feature string")
    assert sorted((r["feature"], r["sample"], r["value"]) for r in fmt.read_matrix(spark, p, keep).collect()) == [("a", "s1", 1.0), ("a", "s2", 2.0)]
    m = fmt.read_sample_map(spark, put(tmp_path, "x.map", "#SmplID\tPath\n#DirPath\t/a\nS1\tp\n#DirPath\t/b\nS2\tq\n"))
    assert sorted((r["sample"], r["directives"]["#DirPath"]) for r in m.collect()) == [("S1", "/a"), ("S2", "/b")]
    with pytest.raises(Exception, match="duplicate sample S1"):
        fmt.read_sample_map(spark, put(tmp_path, "y.map", "S1\tp\nS1\tq\n")).collect()


def test_newick():
    d = fmt.leaf_distances(fmt.newick_edges("((a:1,b:2):0.5,c:3);"))
    assert d == {("a", "b"): 3.0, ("a", "c"): 4.5, ("b", "c"): 5.5}


def test_streaming_windows(spark, tmp_path):
    from pyspark.sql import functions as F

    from granary.streaming.windows import stream_runs, windowed_counts

    src = spark.createDataFrame([(i, f"2024-01-01 00:{i:02d}:00", 1, "a" if i < 3 else "b", 1.0) for i in range(6)], "event_id long, ts string, user_id long, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    src.write.parquet(str(tmp_path / "in"))
    read = lambda: spark.readStream.schema(src.schema).parquet(str(tmp_path / "in"))
    q = windowed_counts(read(), "1 hour").writeStream.outputMode("complete").format("memory").queryName("w").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["event_type"], r["n"]) for r in spark.sql("select * from w").collect()) == [("a", 3), ("b", 3)]
    q = stream_runs(read()).writeStream.outputMode("append").format("memory").queryName("r").option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    q.stop()
    assert [(r["event_type"], r["start"], r["end"], r["n"]) for r in spark.sql("select * from r").collect()] == [("a", 0, 2, 3)]


def test_bins_cutoffs_and_gene_sets(spark, tmp_path):
    from granary.operators import annotation

    cut = put(tmp_path, "cut.txt", "#CALIBRATED CUTOFFS FILE - ALL HITS\nM1\t120\t0.9\t0.8\nM2\t60.5\t1\t1\n")
    assert {tuple(r) for r in fmt.read_cutoffs(spark, cut).collect()} == {("M1", 120.0), ("M2", 60.5)}
    with pytest.raises(ValueError):
        fmt.read_cutoffs(spark, cut, calibrated=False)
    old = put(tmp_path, "q.cm", "Bin Id\t" + "\t".join("abcdefghijklm") + "\nb1\t" + "\t".join(["x"] * 10) + "\t97.5\t1.5\t20\n")
    new = put(tmp_path, "q.cm2", "Name\tCompleteness\tContamination\nb1\t88\t2\textra\n")
    assert tuple(fmt.read_bin_quality(spark, old).first()) == ("b1", 97.5, 1.5, 20.0)
    assert tuple(fmt.read_bin_quality(spark, new).first()) == ("b1", 88.0, 2.0, 0.0)
    assert [tuple(r) for r in fmt.read_bins(spark, put(tmp_path, "bins", "c1\t0\nc2\t3\n")).collect()] == [("c2", "3")]
    sets = fmt.read_gene_sets(spark, put(tmp_path, "sets", "g1\ta\ng2\tb\ng2\ta\n"))
    assert {tuple(r) for r in annotation.last_wins(sets, "gene", "group", "line").collect()} == {("a", "g2", 1), ("b", "g2", 0)}


def test_writers(spark, tmp_path):
    m = spark.createDataFrame([("s1_long_name", "ACGT"), ("s2", "AC-T")], "n string, s string")
    assert fmt.phylip(m, "n", "s").first()["value"] == "2 4\ns1_long_na ACGT\ns2         AC-T\n"
    t = spark.createDataFrame([("cnt", "B", "K1", 1.0), ("GLN", "B", "K1", 2.0)], "norm string, kingdom string, f string, v double")
    fmt.write_tables(t, f"{tmp_path}/t", ["norm", "kingdom"])
    assert spark.read.csv(f"{tmp_path}/t/norm=GLN/kingdom=B", sep="\t", header=True).first()["v"] == "2.0"
    fmt.write_groups(spark.createDataFrame([("g", 2), ("g", 1), ("h", 3)], "g string, m int"), f"{tmp_path}/g", "g", "m")
    assert sorted(r["value"] for r in spark.read.text(f"{tmp_path}/g").collect()) == ["g\t1,2", "h\t3"]
    v = fmt.vcf_lines(spark.createDataFrame([("c", 12, "A", "T"), ("c", 3, "G", "C")], "contig string, pos int, ref string, alt string"))
    assert [r["value"] for r in v.collect()][2:] == ["c\t3\t.\tG\tC\t.\tPASS\t.", "c\t12\t.\tA\tT\t.\tPASS\t."]
    r = fmt.consensus_records(spark.createDataFrame([("c1", "c1 COV=3", "ACGTA")], "c string, h string, s string"), "c", "h", "s", 2)
    assert r.first()["value"] == ">c1 COV=3\nAC\nGT\nA"


def test_fastq_quality_that_begins_with_at(spark, tmp_path):
    rows = [(f"r{i}", "ACGT", "@II@" if i % 3 == 0 else "II@I") for i in range(200)]
    p = put(tmp_path, "b.fq", "".join(f"@{a}\n{b}\n+\n{c}\n" for a, b, c in rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = fmt.read_fastq(spark, p)
        assert got.rdd.getNumPartitions() > 2
        assert sorted((r["id"], r["seq"], r["qual"]) for r in got.collect()) == sorted(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_cluster_blocks(spark):
    got = fmt.cluster_blocks(spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "c")], "core string, m string"), "core", "m").collect()
    assert sorted(r["cluster"] for r in got if r["representative"]) == [0, 1] and len({r["cluster"] for r in got if r["member"] in "ab"}) == 1
