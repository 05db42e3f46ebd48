"""Annotation, report and selection operators over proxies: a gene is a line item, a genome a supplier, its group the nation, a sample the customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequence
from ..operators import annotation, bins, intervals, matrix, reports, selection, similarity, taxonomy
from ..plans.registry import query, table

_HITS = "(SELECT l_orderkey AS query, l_suppkey AS subject, l_quantity * 2 AS pident, l_linenumber * 40 + l_partkey % 50 AS aln_len, l_discount / 1e13 AS evalue, l_extendedprice / 100 AS bitscore, l_partkey FROM lineitem) h"


def hits(spark, d):
    return table(spark, d, "lineitem").selectExpr("l_orderkey as query", "l_suppkey as subject", "l_quantity * 2 as pident", "l_linenumber * 40 + l_partkey % 50 as aln_len", "l_discount / 1e13D as evalue", "l_extendedprice / 100 as bitscore", "l_partkey")


@query("SELECT term, count(*) AS n FROM (SELECT DISTINCT p_partkey, unnest(string_split(p_type || ' ' || p_name, ' ')) AS term FROM part) WHERE term != '' GROUP BY 1")
def s23_term_index(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_type", "p_name").alias("terms"))
    return annotation.explode_terms(p, "p_partkey", "terms", " ").groupBy("term").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, [x FOR x IN [CASE WHEN c_acctbal > 5000 THEN 'rich' END, CASE WHEN c_nationkey < 10 THEN 'near' END, CASE WHEN c_custkey % 2 = 0 THEN 'even' END] IF x IS NOT NULL] AS marks FROM customer")
def s23_flag_columns(spark, d):
    yes = lambda c: F.when(c, "YES").otherwise("NO")
    c = table(spark, d, "customer").select("c_custkey", yes(F.col("c_acctbal") > 5000).alias("rich"), yes(F.col("c_nationkey") < 10).alias("near"), yes(F.col("c_custkey") % 2 == 0).alias("even"))
    return c.select("c_custkey", annotation.flagged(["rich", "near", "even"]).alias("marks"))


@query("""
WITH c AS (SELECT p_partkey, concat_ws('.', p_size // 10 + 1, p_size % 10, p_partkey % 3) AS code FROM part)
SELECT level, name, count(*) AS n FROM (SELECT CAST(i - 1 AS INTEGER) AS level, array_to_string(string_split(code, '.')[1:i], '.') AS name FROM c, range(1, 4) t(i)) GROUP BY ALL""")
def s23_hierarchy_levels(spark, d):
    p = table(spark, d, "part").selectExpr("p_partkey", "concat_ws('.', p_size div 10 + 1, p_size % 10, p_partkey % 3) as code")
    return annotation.hierarchy_levels(p, "code").groupBy("level", "name").agg(F.count("*").alias("n"))


@query("""
WITH x AS (SELECT p_brand AS g, p_partkey AS gene, CASE WHEN p_size % 4 = 0 THEN '-' ELSE p_type END AS og FROM part),
k AS (SELECT g, gene, CASE WHEN og = '-' THEN 'uniq' || sum((og = '-')::INT) OVER (PARTITION BY g ORDER BY gene ROWS UNBOUNDED PRECEDING) ELSE og END AS og FROM x),
f AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY g, og ORDER BY gene) = 1) SELECT g, gene, og FROM f QUALIFY row_number() OVER (PARTITION BY g ORDER BY gene) <= 8""")
def s27_first_of_family(spark, d):
    x = table(spark, d, "part").selectExpr("p_brand as g", "p_partkey as gene", "if(p_size % 4 = 0, '-', p_type) as og")
    return annotation.first_of_family(x, "g", "gene", "og", ["gene"], 8)


@query("""
WITH l AS (SELECT c_custkey, string_split(repeat(concat_ws(chr(9), 'a', c_name, 'b', 'c', 'd', 'e', c_mktsegment, 'f') || chr(9), CAST(c_custkey % 3 AS BIGINT)) || 'a' || chr(9) || 'rest', chr(9)) AS f FROM customer)
SELECT c_custkey, f[8 * i + 2] AS key, f[8 * i + 7] AS value FROM l, range(0, 4) t(i) WHERE 8 * i + 6 < len(f)""")
def s29_wide_records(spark, d):
    line = F.concat(F.expr("repeat(concat(concat_ws('\\t', 'a', c_name, 'b', 'c', 'd', 'e', c_mktsegment, 'f'), '\\t'), cast(c_custkey % 3 as int))"), F.lit("a\trest"))
    x = table(spark, d, "customer").select("c_custkey", F.explode(annotation.wide_records(line)).alias("r"))
    return x.select("c_custkey", "r.key", "r.value")


@query("""
WITH f AS (SELECT 'lib' || (c_custkey // 2) || CASE c_custkey % 2 WHEN 0 THEN '.R1.fq' ELSE '.R2.fq' END AS file FROM customer WHERE c_custkey % 7 != 0)
SELECT replace(replace(file, '.R1', ''), '.R2', '') AS stem, min(CASE WHEN file LIKE '%.R1.fq' THEN file END) AS r1, min(CASE WHEN file LIKE '%.R2.fq' THEN file END) AS r2, count(DISTINCT file) = 2 AS paired FROM f GROUP BY 1""")
def s32_paired_files(spark, d):
    f = table(spark, d, "customer").where("c_custkey % 7 != 0").selectExpr("concat('lib', c_custkey div 2, if(c_custkey % 2 = 0, '.R1.fq', '.R2.fq')) as file")
    return annotation.pair_files(f, "file", r"\.R1", r"\.R2")


@query("SELECT fate, count(*) AS n FROM (SELECT CASE WHEN l_discount <= 0.05 THEN 'accepted' WHEN l_quantity > 30 THEN 'queued' ELSE 'dropped' END AS fate FROM lineitem) GROUP BY 1")
def p04_split_by_divergence(spark, d):
    return annotation.split_by_divergence(table(spark, d, "lineitem"), "l_discount", "l_quantity", 0.05, 30).groupBy("fate").agg(F.count("*").alias("n"))


@query("SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1")
def p07_rows_of_passing(spark, d):
    ok = table(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return annotation.of_passing(table(spark, d, "lineitem").select("l_suppkey"), ok, "l_suppkey").groupBy("l_suppkey").agg(F.count("*").alias("n"))


@query("SELECT doc_id, CASE WHEN length(text) >= 255 THEN left(text, 250) || '/1' ELSE text END AS header FROM documents")
def p10_short_headers(spark, d):
    return table(spark, d, "documents").select("doc_id", annotation.short_header(F.col("text"), 1).alias("header"))


@query(f"SELECT query, bool_or(subject % 5 < 2) AS prokaryote FROM {_HITS} WHERE evalue <= 5e-15 AND pident >= 70 GROUP BY 1")
def p19_contigs_by_kingdom(spark, d):
    kingdoms = table(spark, d, "supplier").selectExpr("s_suppkey as taxid", "s_suppkey % 5 as kingdom")
    named = hits(spark, d).withColumn("subject", F.concat(F.col("subject").cast("string"), F.lit(".gene")))
    return annotation.contigs_by_kingdom(named, kingdoms, 5e-15, 70.0)


@query(f"SELECT query, max(CASE WHEN bitscore < 120 OR evalue > 5e-15 THEN 0 ELSE pident END) AS best FROM {_HITS} GROUP BY 1")
def p20_guarded_hits(spark, d):
    return annotation.guarded(hits(spark, d), 120.0, 5e-15).groupBy("query").agg(F.max("pident").alias("best"))


@query("SELECT n_nationkey, n_name FROM nation WHERE n_nationkey BETWEEN 3 AND 20 AND n_name NOT IN ('NATION_5', 'NATION_7')")
def p22_sample_range(spark, d):
    return annotation.sample_range(table(spark, d, "nation"), "n_nationkey", "n_name", 3, 20, ("NATION_5", "NATION_7")).select("n_nationkey", "n_name")


@query("""
WITH g AS (SELECT l_suppkey AS bin, l_orderkey AS contig, list(CAST(l_partkey AS VARCHAR) ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) || [''] AS genes FROM lineitem GROUP BY ALL)
SELECT bin, flatten(list(genes ORDER BY contig)) AS genes FROM g GROUP BY 1""")
def j07_contig_genes(spark, d):
    li = table(spark, d, "lineitem")
    genes = li.selectExpr("l_suppkey as sample", "l_orderkey as contig", "l_linenumber as ordinal", "l_partkey as gene")
    return annotation.contig_genes(li.selectExpr("l_suppkey as bin", "l_suppkey as sample", "l_orderkey as contig").distinct(), genes)


@query("""
SELECT sample, contig, list(DISTINCT l_linenumber ORDER BY l_linenumber) AS ordinals FROM (SELECT 'S' || l_suppkey AS sample, 'C' || l_partkey AS contig, l_linenumber FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 20) GROUP BY ALL""")
def s10b_genes_of_contigs(spark, d):
    raw = table(spark, d, "lineitem").select(F.expr("concat('S', l_suppkey, '__C', l_partkey, '_L=100=_', l_linenumber)").alias("raw"))
    genes = raw.select(sequence.gene_id(F.col("raw")).alias("g")).select("g.sample", "g.contig", F.col("g.gene").alias("ordinal"))
    keep = table(spark, d, "part").where("p_size > 20").select(F.expr("concat('C', p_partkey)").alias("contig"))
    return annotation.genes_by_contig(genes, genes.select("sample", "contig").join(keep, "contig", "left_semi"))


@query("SELECT g, l_suppkey AS sample, sum(l_quantity) AS value FROM lineitem JOIN (SELECT p_partkey AS l_partkey, unnest([p_brand, p_type]) AS g FROM part) USING (l_partkey) GROUP BY ALL")
def j12_submatrices(spark, d):
    m = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("feature"), F.col("l_suppkey").alias("sample")).agg(F.sum("l_quantity").alias("value"))
    members = table(spark, d, "part").select(F.col("p_partkey").alias("feature"), F.explode(F.array("p_brand", "p_type")).alias("g"))
    return annotation.submatrices(m, members).groupBy("g", "sample").agg(F.sum("value").alias("value"))


@query("SELECT c_mktsegment AS country, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey > 3 GROUP BY 1")
def j17_with_metadata(spark, d):
    meta = table(spark, d, "customer").selectExpr("c_custkey as o_custkey", "if(c_nationkey > 3, c_mktsegment, ' ') as country")
    return annotation.with_metadata(table(spark, d, "orders").select("o_custkey"), meta, "o_custkey", "country").groupBy("country").agg(F.count("*").alias("n"))


@query("""
SELECT coalesce(n.name, CAST(c.c_nationkey AS VARCHAR)) AS name, list(DISTINCT c_custkey ORDER BY c_custkey) AS items FROM customer c LEFT JOIN (SELECT n_nationkey, 'R' || n_regionkey AS name FROM nation WHERE n_nationkey < 15) n ON c.c_nationkey = n.n_nationkey GROUP BY 1""")
def j18_transferred_groups(spark, d):
    groups = table(spark, d, "customer").selectExpr("cast(c_nationkey as string) as old", "c_custkey")
    names = table(spark, d, "nation").where("n_nationkey < 15").selectExpr("cast(n_nationkey as string) as old", "concat('R', n_regionkey) as name")
    return annotation.transfer(groups, names, "old", "name", "c_custkey")


@query("SELECT l_partkey, coalesce(p_brand, '-') AS label FROM (SELECT DISTINCT l_partkey FROM lineitem) LEFT JOIN (SELECT * FROM part WHERE p_size > 25) ON l_partkey = p_partkey")
def j19_relabelled(spark, d):
    names = table(spark, d, "part").where("p_size > 25").selectExpr("p_partkey as l_partkey", "p_brand as label")
    return annotation.relabel(table(spark, d, "lineitem").select("l_partkey").distinct(), names, "l_partkey", "label", "-")


@query("SELECT DISTINCT l_partkey AS gene, s_name AS seq FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey WHERE p_size = 7")
def x07_attached_sequences(spark, d):
    index = table(spark, d, "lineitem").selectExpr("l_partkey as gene", "l_suppkey as member").distinct()
    ids = table(spark, d, "part").where("p_size = 7").selectExpr("p_partkey as gene")
    return annotation.attach_sequences(ids, index, table(spark, d, "supplier").selectExpr("s_suppkey as member", "s_name as seq"))


@query("SELECT l_partkey, list(DISTINCT l_suppkey ORDER BY l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1")
def x08_inverted_index(spark, d):
    return annotation.invert(table(spark, d, "lineitem"), "l_suppkey", "l_partkey")


@query("SELECT o_custkey AS gene, max_by(o_orderkey, o_orderkey) AS g, count(*) - 1 AS repeats FROM orders GROUP BY 1")
def s20_last_group_wins(spark, d):
    return annotation.last_wins(table(spark, d, "orders").selectExpr("o_custkey as gene", "o_orderkey as g", "o_orderkey as line"), "gene", "g", "line")


@query("""
WITH l AS (SELECT p_partkey, [p_brand, p_type, 'x' || p_size] AS r FROM part), a AS (SELECT p_partkey, CASE WHEN r[3] = 'x7' THEN [r[1], 'seven', r[3]] ELSE r END AS r FROM l)
SELECT p_partkey, array_to_string(CASE WHEN r[2] = 'seven' THEN ['S', r[2], r[3]] ELSE r END, ';') AS lineage FROM a""")
def x16_rewritten_ranks(spark, d):
    ranks = F.array("p_brand", "p_type", F.concat(F.lit("x"), F.col("p_size").cast("string")))
    return table(spark, d, "part").select("p_partkey", F.array_join(annotation.rewrite_ranks(ranks, [(2, "x7", 1, "seven"), (1, "seven", 0, "S")]), ";").alias("lineage"))


@query("SELECT l_orderkey AS gene, 'k__' || r_name || ';p__' || n_name || ';c__' || s_name AS lineage FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def x17_gene_lineages(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    genomes = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("genome"), F.array("r_name", "n_name", "s_name").alias("ranks"))
    return annotation.gene_lineages(table(spark, d, "lineitem").selectExpr("l_orderkey as gene", "l_suppkey as genome").distinct(), genomes, "kpc")


@query("SELECT 'S' || (c_custkey % 9) || '__C' || c_custkey || '_1' AS member, (CASE WHEN c_custkey % 2 = 0 THEN 'T' || c_nationkey ELSE 'S' || (c_custkey % 9) END) || '__C' || c_custkey || '_1' AS repaired FROM customer")
def x27_repaired_names(spark, d):
    c = table(spark, d, "customer")
    known = c.where("c_custkey % 2 = 0").selectExpr("concat('C', c_custkey) as contig", "concat('T', c_nationkey) as sample")
    return annotation.repaired_names(c.selectExpr("concat('S', c_custkey % 9, '__C', c_custkey, '_1') as member"), known)


@query("""
WITH b AS (SELECT [r_name, n_name, c_mktsegment] AS l, o_orderpriority AS sample, o_totalprice AS v FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT CAST(i AS INTEGER) AS level, array_to_string(l[1:i], ';') AS name, sample, round(sum(v), 2) AS value FROM b, range(1, 4) t(i) GROUP BY ALL""")
def a17_rank_matrices(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat_ws(";", "r_name", "n_name", "c_mktsegment").alias("lineage"))
    o = table(spark, d, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).selectExpr("lineage", "o_orderpriority as sample", "o_totalprice as value")
    return reports.rank_matrix(o, "lineage", "sample", "value").withColumn("value", F.round("value", 2))


@query("SELECT n_name AS name, s_suppkey, s_acctbal AS value FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 3 = 0")
def a09_clades_of_rank(spark, d):
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    t = s.selectExpr("concat('k__B|p__', n_name, if(s_suppkey % 3 = 0, '', '|c__other')) as clade", "s_suppkey", "s_acctbal as value")
    return reports.clades_of_rank(t, "clade", "p").select("name", "s_suppkey", "value")


@query("""
WITH b AS (SELECT l_returnflag AS f, CASE l_linenumber WHEN 1 THEN 's1' WHEN 2 THEN 's2' ELSE 's3' END AS s, l_quantity AS q, l_extendedprice AS e FROM lineitem WHERE NOT (l_returnflag = 'A' AND l_linenumber = 1)),
m AS (SELECT 'freq' AS measure, f, s, sum(q) AS v FROM b GROUP BY ALL UNION ALL SELECT 'cnt', f, s, CAST(count(*) AS DOUBLE) FROM b GROUP BY ALL)
SELECT measure, f, coalesce(max(v) FILTER (s = 's1'), 0) AS s1, coalesce(max(v) FILTER (s = 's2'), 0) AS s2, coalesce(max(v) FILTER (s = 's3'), 0) AS s3 FROM m GROUP BY ALL""")
def a32_depth_matrices(spark, d):
    b = table(spark, d, "lineitem").where("not (l_returnflag = 'A' and l_linenumber = 1)").selectExpr("l_returnflag as f", "case l_linenumber when 1 then 's1' when 2 then 's2' else 's3' end as s", "l_quantity as q")
    g = b.groupBy("f", "s").agg(F.sum("q").alias("freq"), F.count("*").cast("double").alias("cnt"))
    return reports.filled(g, "f", ["s1", "s2", "s3"], "s", ["freq", "cnt"])


@query("""
WITH g AS (SELECT l_suppkey AS genome, l_orderkey AS contig, l_linenumber AS ordinal, l_partkey AS gene, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS category FROM lineitem),
w AS (SELECT genome, array_to_string(list(DISTINCT CAST(gene AS VARCHAR) ORDER BY CAST(gene AS VARCHAR)) FILTER (category = 'A'), ',') AS "A", array_to_string(list(DISTINCT CAST(gene AS VARCHAR) ORDER BY CAST(gene AS VARCHAR)) FILTER (category = 'R'), ',') AS "R" FROM g GROUP BY 1),
c AS (SELECT genome, contig, array_to_string(list(CAST(gene AS VARCHAR) ORDER BY ordinal, CAST(gene AS VARCHAR)), ',') AS t FROM g WHERE category IS NULL GROUP BY ALL),
r AS (SELECT genome, array_to_string(list(t ORDER BY contig), '|') AS rest FROM c GROUP BY 1)
SELECT s_suppkey AS genome, s_nationkey AS "group", s_acctbal AS compl, CAST(s_suppkey % 10 AS DOUBLE) AS conta, CASE WHEN row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal - 2 * (s_suppkey % 10) DESC, s_suppkey) = 1 THEN '*' ELSE '' END AS star, "A", "R", rest
FROM supplier LEFT JOIN w ON s_suppkey = w.genome LEFT JOIN r ON s_suppkey = r.genome""")
def a27_genome_content(spark, d):
    g = table(spark, d, "lineitem").selectExpr("l_suppkey as genome", "l_orderkey as contig", "l_linenumber as ordinal", "l_partkey as gene", "nullif(l_returnflag, 'N') as category")
    s = table(spark, d, "supplier").selectExpr("s_suppkey as genome", "s_nationkey as `group`", "s_acctbal as compl", "cast(s_suppkey % 10 as double) as conta")
    return reports.genome_content(g, s, ["A", "R"])


@query("SELECT l_suppkey, count(*) AS n, round(quantile_cont(l_extendedprice, 0.1), 6) AS q10, round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.9), 6) AS q90 FROM lineitem GROUP BY 1")
def a36_quantile_report(spark, d):
    r = reports.quantile_report(table(spark, d, "lineitem"), "l_suppkey", "l_extendedprice", (0.1, 0.5, 0.9))
    return r.select("l_suppkey", "n", *[F.round(c, 6).alias(c) for c in ("q10", "q50", "q90")])


@query("SELECT l_suppkey AS gene, count(*) FILTER (l_discount * 10 > 0.9) AS negative, count(*) FILTER (l_tax * 12 > 0.9) AS positive, median(l_quantity) AS median_dn, round(avg(l_quantity), 6) AS mean_dn, median(l_tax) AS median_ds, round(avg(l_tax), 6) AS mean_ds FROM lineitem GROUP BY 1")
def a38_selection_summary(spark, d):
    x = table(spark, d, "lineitem").selectExpr("l_suppkey as gene", "l_discount * 10 as p_neg", "l_tax * 12 as p_pos", "l_quantity as dn", "l_tax as ds")
    return reports.selection_summary(x, "gene")


@query(f"SELECT round(sum(covered) / sum(s_suppkey * 1000), 6) AS ratio FROM (SELECT subject, sum(aln_len) AS covered FROM {_HITS} WHERE pident > 98 GROUP BY 1) JOIN supplier ON subject = s_suppkey")
def a42_duplicate_ratio(spark, d):
    lengths = table(spark, d, "supplier").selectExpr("s_suppkey as contig", "s_suppkey * 1000 as length")
    return reports.duplicate_ratio(hits(spark, d).withColumnRenamed("subject", "contig"), lengths)


@query("""
WITH k AS (SELECT l_suppkey, l_discount AS m, count(*) AS c FROM lineitem GROUP BY ALL), t AS (SELECT l_suppkey, m AS mode FROM k QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY c DESC, m) = 1),
s AS (SELECT l_suppkey, count(*) AS n, round(sum(l_discount * l_quantity) / sum(l_quantity), 6) AS mean, round(stddev_samp(l_discount), 6) AS sd FROM lineitem GROUP BY 1) SELECT l_suppkey, n, mean, mode, sd FROM s JOIN t USING (l_suppkey)""")
def a44_distance_summary(spark, d):
    return reports.distance_summary(table(spark, d, "lineitem"), ["l_suppkey"], "l_discount", "l_quantity")


@query("""
SELECT l_partkey, max(l_quantity) FILTER (l_returnflag = 'A') AS "A", max(l_quantity) FILTER (l_returnflag = 'N') AS "N", max(l_quantity) FILTER (l_returnflag = 'R') AS "R", CAST(count(DISTINCT l_returnflag) AS INTEGER) AS found FROM lineitem GROUP BY 1""")
def a45_markers_across_runs(spark, d):
    return reports.across_runs(table(spark, d, "lineitem"), "l_partkey", "l_returnflag", "l_quantity", ["A", "N", "R"])


@query("SELECT count(*) AS records, CAST(sum(p_size) AS BIGINT) AS covered, CAST(sum(p_size % 7) AS BIGINT) AS replaced FROM part")
def a47_consensus_totals(spark, d):
    size = F.col("p_size").cast("long")
    h = table(spark, d, "part").select(reports.consensus_header(F.col("p_name"), size, size % 7, F.lit(0)).alias("header"))
    return reports.consensus_totals(h, "header")


@query("SELECT p_partkey, coalesce(n, 0) AS hits FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_quantity > 45 GROUP BY 1) ON p_partkey = l_partkey")
def a49_hits_per_gene(spark, d):
    h = table(spark, d, "lineitem").where("l_quantity > 45").selectExpr("l_partkey as p_partkey")
    return reports.hits_per_gene(h, table(spark, d, "part"), "p_partkey")


@query("""
WITH p AS (SELECT doc_id, translate(text, ' ', 'N') AS r, translate(text, 'ae ', 'eaN') AS c FROM documents)
SELECT doc_id AS contig, CAST(i AS INTEGER) AS pos, r[i] AS ref, c[i] AS alt FROM (SELECT doc_id, r, c, unnest(range(1, length(r) + 1)) AS i FROM p) WHERE r[i] != c[i] AND r[i] != 'N' AND c[i] != 'N'""")
def k09_consensus_variants(spark, d):
    t = table(spark, d, "documents")
    ref, con = t.selectExpr("doc_id as contig", "translate(text, ' ', 'N') as seq"), t.selectExpr("doc_id as contig", "translate(text, 'ae ', 'eaN') as seq")
    return reports.differences_as_variants(ref, con)


@query("SELECT l_partkey, l_suppkey FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) >= 35)")
def x09_groups_of_size(spark, d):
    return reports.of_size(table(spark, d, "lineitem"), "l_partkey", 35).select("l_partkey", "l_suppkey")


@query("SELECT l_suppkey AS genome, sum(l_quantity) AS total FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal >= 80 AND s_suppkey % 10 <= 5 GROUP BY 1")
def x10_good_genomes(spark, d):
    q = table(spark, d, "supplier").selectExpr("s_suppkey as genome", "s_acctbal as compl", "s_suppkey % 10 as conta")
    stats = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("genome")).agg(F.sum("l_quantity").alias("total"))
    return reports.good_genomes(q, stats, "genome").select("genome", "total")


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) <= 3")
def l04_first_reads(spark, d):
    return reports.first_reads(table(spark, d, "orders"), "o_custkey", "o_orderpriority", "o_orderkey", 3).select("o_custkey", "o_orderkey")


@query(f"SELECT query, count(*) AS n, CAST(1 AS BIGINT) AS pieces FROM {_HITS} GROUP BY 1")
def x23_hit_pieces(spark, d):
    return reports.hit_pieces(hits(spark, d), "query", 16).groupBy("query").agg(F.count("*").alias("n"), F.countDistinct("piece").alias("pieces"))


_LIST = "list({'p': pident, 'l': aln_len, 'b': bitscore, 's': subject, 'ever': pident} ORDER BY bitscore DESC, evalue, subject, pident, aln_len)"
_CONVINCING = "x.p > a.p - 5 AND ((x.p >= a.p * 0.97 AND x.p >= a.ever * 0.9 AND x.l >= a.l * 1.15) OR (x.p >= a.p * 1.03 AND x.l >= a.l * 0.9) OR x.b > a.b * 0.8)"


@query(f"""
WITH f AS (SELECT query, list_reduce({_LIST}, lambda a, x: CASE WHEN {_CONVINCING} THEN {{'p': x.p, 'l': x.l, 'b': x.b, 's': x.s, 'ever': greatest(a.ever, x.p)}} ELSE a END) AS f FROM {_HITS} GROUP BY 1)
SELECT query, f.s AS subject, f.p AS pident, f.l AS aln_len, f.b AS bitscore FROM f""")
def w05_convincing_hit(spark, d):
    return selection.fold_convincing(hits(spark, d), "query")


@query(f"""
WITH f AS (SELECT query, list_reduce(list({{'s': subject, 'p': pident, 'l': aln_len}} ORDER BY subject, pident, aln_len), lambda a, x: CASE WHEN (x.p > a.p AND x.l > a.l) OR (x.l > a.l * 1.4 AND x.p > a.p * 0.9) THEN x ELSE a END) AS f FROM {_HITS} GROUP BY 1)
SELECT query, f.p AS pident, f.l AS aln_len FROM f""")
def x24_best_identity(spark, d):
    return selection.best_identity(hits(spark, d), "query", "subject")


@query("""
WITH o AS (SELECT s_nationkey AS g, s_suppkey AS genome, l_partkey AS gene, count(*) AS occ, l_partkey % 20 = 0 AS m FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
s AS (SELECT g, genome, sum(occ * CASE WHEN m THEN 2 ELSE 1 END) / count(*) AS w FROM o GROUP BY ALL),
c AS (SELECT g, genome, w / 10.0 + 0.01 * (s_acctbal - 2 * (s_suppkey % 10)) AS score FROM s JOIN supplier ON genome = s_suppkey)
SELECT g AS "group", genome, round(score, 6) AS score FROM c QUALIFY row_number() OVER (PARTITION BY g ORDER BY score DESC, genome) = 1""")
def w11_representative_genome(spark, d):
    s = table(spark, d, "supplier")
    g = table(spark, d, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("s_nationkey").alias("group"), F.col("s_suppkey").alias("genome"), F.col("l_partkey").alias("gene"))
    genes = g.agg(F.count("*").alias("occ")).withColumn("is_marker", F.col("gene") % 20 == 0)
    return selection.representative_genome(genes, s.selectExpr("s_suppkey as genome", "s_acctbal as compl", "s_suppkey % 10 as conta", "10.0D as observed"))


@query("""
WITH b AS (SELECT s_nationkey AS g, s_suppkey AS genome, s_acctbal AS compl, CAST(s_suppkey % 10 AS DOUBLE) AS conta FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY (s_acctbal - 2 * (s_suppkey % 10)) * (1000 + s_suppkey) DESC, s_suppkey DESC) = 1),
n AS (SELECT n_nationkey AS g, n_nationkey * 300.0::DOUBLE AS compl, 5.0::DOUBLE AS conta, n_nationkey % 3 = 0 AS passes FROM nation)
SELECT n.g AS "group", CASE WHEN x THEN genome END AS genome, CASE WHEN x THEN b.compl ELSE n.compl END AS compl, CASE WHEN x THEN b.conta ELSE n.conta END AS conta
FROM (SELECT n.*, coalesce(NOT passes AND b.compl - 2 * b.conta > n.compl - 2 * n.conta, FALSE) AS x FROM n LEFT JOIN b USING (g)) n LEFT JOIN b USING (g)""")
def w12_replaced_groups(spark, d):
    genomes = table(spark, d, "supplier").selectExpr("s_nationkey as `group`", "s_suppkey as genome", "s_acctbal as compl", "cast(s_suppkey % 10 as double) as conta", "1000 + s_suppkey as n50")
    groups = table(spark, d, "nation").selectExpr("n_nationkey as `group`", "n_nationkey * 300.0D as compl", "5.0D as conta", "n_nationkey % 3 = 0 as passes")
    return selection.replace_groups(groups, genomes)


@query("""
WITH s AS (SELECT l_partkey AS gene, l_orderkey AS species, l_quantity AS size FROM lineitem), q AS (SELECT gene, list_sort(list(size))[least(CAST(floor(count(*) * 0.9) AS INT), CAST(count(*) AS INT) - 1) + 1] AS q FROM s GROUP BY 1),
k AS (SELECT s.* FROM s JOIN q USING (gene) WHERE size >= q * 0.5), n AS (SELECT gene, count(*) AS n FROM k GROUP BY 1)
SELECT species, gene, size FROM k JOIN n USING (gene) WHERE n >= (SELECT quantile_cont(n, 0.9) FROM n) * 0.8""")
def p15_long_sequences(spark, d):
    s = table(spark, d, "lineitem").selectExpr("l_partkey as gene", "l_orderkey as species", "l_quantity as size")
    return selection.long_sequences(s, gene_share=0.8)


@query("""
WITH c AS (SELECT o_custkey AS name, sum(o_totalprice) AS n FROM orders GROUP BY 1), q AS (SELECT quantile_cont(n, 0.9) AS hi, quantile_cont(n, 0.25) AS lo, max(n) AS top FROM c)
SELECT name, round(n, 2) AS n FROM c, q WHERE NOT ((n < hi * 0.6 AND n < lo) OR n < top / 5)""")
def p16_full_sequences(spark, d):
    c = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("name")).agg(F.sum("o_totalprice").alias("n"))
    return selection.full_sequences(c, "name", "n", 0.6, 5.0).withColumn("n", F.round("n", 2))


@query("""
WITH v AS (SELECT l_partkey AS gene, l_linenumber AS sample, sum(l_quantity) AS x FROM lineitem GROUP BY ALL), p AS (SELECT l_suppkey AS g, l_linenumber AS sample, sum(l_quantity) AS y FROM lineitem GROUP BY ALL),
c AS (SELECT DISTINCT l_partkey AS gene, l_suppkey AS g, l_partkey % 10 AS category FROM lineitem), t AS (SELECT DISTINCT l_partkey AS gene, l_suppkey AS g, l_partkey % 10 AS category FROM lineitem WHERE l_quantity > 49),
f AS (SELECT * FROM c WHERE (g, category) NOT IN (SELECT g, category FROM t) AND gene NOT IN (SELECT gene FROM t)),
r AS (SELECT gene, g, coalesce(CASE WHEN stddev_pop(x) * stddev_pop(y) > 0 THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END, 0) AS r FROM f JOIN v USING (gene) JOIN p USING (g, sample) GROUP BY ALL)
SELECT gene, g AS "group", round(r, 4) AS r FROM r WHERE round(r, 4) >= 0.6""")
def m11_rescued_genes(spark, d):
    li = table(spark, d, "lineitem")
    genes = li.groupBy(F.col("l_partkey").alias("gene"), F.col("l_linenumber").alias("sample")).agg(F.sum("l_quantity").alias("value"))
    profiles = li.groupBy(F.col("l_suppkey").alias("group"), F.col("l_linenumber").alias("sample")).agg(F.sum("l_quantity").alias("value"))
    pairs = lambda x: x.selectExpr("l_partkey as gene", "l_suppkey as `group`", "l_partkey % 10 as category").distinct()
    return selection.rescued(pairs(li), profiles, genes, pairs(li.where("l_quantity > 49")))


@query("""
WITH m AS (SELECT l_partkey AS gene, l_suppkey AS member FROM lineitem), t AS (SELECT p_partkey AS gene, p_partkey // 4 * 4 + 1 AS target FROM part WHERE p_partkey % 4 > 1),
g AS (SELECT coalesce(target, m.gene) AS gene, list(DISTINCT member ORDER BY member) AS members FROM m LEFT JOIN t USING (gene) GROUP BY 1)
SELECT gene, coalesce(g.members, []) AS members FROM (SELECT DISTINCT gene FROM m) LEFT JOIN g USING (gene)""")
def u07_declutter_merge(spark, d):
    merges = table(spark, d, "part").where("p_partkey % 4 > 1").selectExpr("p_partkey as gene", "p_partkey div 4 * 4 + 1 as target")
    return selection.declutter(table(spark, d, "lineitem").selectExpr("l_partkey as gene", "l_suppkey as member"), merges)


@query("SELECT l_suppkey, l_returnflag AS marker, list(DISTINCT l_partkey ORDER BY l_partkey) AS genes FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_partkey) > 1")
def x18_repeated_markers(spark, d):
    return selection.repeated_markers(table(spark, d, "lineitem").withColumnRenamed("l_returnflag", "marker"), "l_suppkey", "marker", "l_partkey")


@query("SELECT o_orderkey, CAST((o_orderkey % 5 * 24 + o_orderkey % 24) * 3600 + o_orderkey % 60 * 60 + 7 AS BIGINT) AS seconds, CAST(o_orderkey % 900 AS DOUBLE) / 1024 AS gb FROM orders")
def f20_durations_and_sizes(spark, d):
    o = table(spark, d, "orders").selectExpr("o_orderkey", "concat(o_orderkey % 5, '-', lpad(o_orderkey % 24, 2, '0'), ':', lpad(o_orderkey % 60, 2, '0'), ':07') as t", "concat(o_orderkey % 900, 'M') as s")
    return o.select("o_orderkey", selection.duration_seconds(F.col("t")).alias("seconds"), selection.gigabytes(F.col("s")).alias("gb"))


@query("SELECT s_suppkey, '/data/in/' || s_name || '/$OTHER' AS path FROM supplier")
def f21_resolved_paths(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", selection.resolve_path(F.expr("concat('$ROOT/in/', s_name, '/$OTHER')"), {"ROOT": "/data", "ROO": "x"}).alias("path"))


@query("SELECT p_partkey, unnest(['@' || p_partkey || '/1', '@' || p_partkey || '/2']) AS name, unnest([left(p_name, 2), p_name[4:5]]) AS seq FROM part")
def f27_split_pairs(spark, d):
    x = table(spark, d, "part").select("p_partkey", F.explode(selection.split_pair(F.expr("concat('@', p_partkey, ';2;')"), F.col("p_name"), F.col("p_name"))).alias("r"))
    return x.select("p_partkey", "r.name", "r.seq")


@query("SELECT c_nationkey, count(DISTINCT c_custkey) AS n, list(DISTINCT c_custkey ORDER BY c_custkey) AS members FROM customer GROUP BY 1 HAVING count(DISTINCT c_custkey) >= 5")
def l06_guide_groups(spark, d):
    return selection.guide_groups(table(spark, d, "customer"), "c_nationkey", "c_custkey", 5)


@query("""
WITH p AS (SELECT c_mktsegment AS g, ['root', 'R' || n_regionkey, 'N' || n_nationkey] AS path FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1 OR c_mktsegment < 'F'),
n AS (SELECT g, count(*) AS n FROM p GROUP BY 1), e AS (SELECT g, i, path[i] AS node, count(*) AS k FROM p, range(1, 4) t(i) GROUP BY ALL)
SELECT g, max_by(node, i) AS ancestor FROM e JOIN n USING (g) WHERE k = n GROUP BY 1""")
def x22_common_ancestors(spark, d):
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).where("n_regionkey = 1 or c_mktsegment < 'F'")
    paths = c.select(F.col("c_mktsegment").alias("g"), F.array(F.lit("root"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")), F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))).alias("path"))
    return selection.common_ancestor(paths, "g", "path")


@query("SELECT '>' || doc_id || chr(10) || text AS record FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def x25_assigned_reads(spark, d):
    reads = table(spark, d, "documents").selectExpr("doc_id as id", "text as seq")
    return selection.as_fasta(reads, table(spark, d, "labels").selectExpr("doc_id as id"))


@query(f"SELECT count(*) AS n, count(DISTINCT query) AS queries FROM {_HITS}")
def l02_sorted_hits(spark, d):
    return reports.sorted_hits(hits(spark, d), "query", [F.desc("bitscore"), F.asc("subject")]).agg(F.count("*").alias("n"), F.countDistinct("query").alias("queries"))


@query()
def m12_tiered_groups(spark, d):
    """Bins are orders of a customer's nation, their marker genes parts of a small range."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    li = table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    members = li.select(F.col("c_nationkey").alias("block"), F.col("l_orderkey").alias("name"), (F.col("l_partkey") % 12).alias("item"))
    quality = o.selectExpr("c_nationkey as block", "o_orderkey as name", "60 + cast(o_orderkey % 41 as double) as compl", "cast(o_orderkey % 11 as double) as conta", "0.9D + (o_orderkey % 10) / 100D as agreement")
    return bins.tiered_groups(members, quality, "block", "name", "item")


@query()
def m15_similar_sequences(spark, d):
    return similarity.similar_groups(table(spark, d, "benchmark"), "item_id", "text")


@query("SELECT 'a' AS profile, level, name, sample, value FROM (SELECT 1::INT AS level, c_mktsegment AS name, 's' || c_nationkey AS sample, sum(c_acctbal) AS value FROM customer WHERE c_nationkey < 12 GROUP BY ALL UNION ALL SELECT 1, c_mktsegment, 's' || c_nationkey, sum(c_acctbal) FROM customer WHERE c_nationkey >= 12 GROUP BY ALL)")
def a07_merged_profiles(spark, d):
    c = table(spark, d, "customer").selectExpr("c_mktsegment as lineage", "concat('s', c_nationkey) as sample", "c_acctbal as value", "c_nationkey")
    files = {"a": c.where("c_nationkey < 12").drop("c_nationkey"), "b": c.where("c_nationkey >= 12").drop("c_nationkey")}
    return reports.rank_matrix(reports.union_summaries(files, "file"), "lineage", "sample", "value").select(F.lit("a").alias("profile"), "level", "name", "sample", "value")


@query("SELECT l_partkey AS feature, coalesce(max(q) FILTER (f = 'A'), 0) AS \"A\", coalesce(max(q) FILTER (f = 'N'), 0) AS \"N\", coalesce(max(q) FILTER (f = 'R'), 0) AS \"R\", 'depth' AS measure FROM (SELECT l_partkey, l_returnflag AS f, median(l_quantity) AS q FROM lineitem GROUP BY ALL) GROUP BY 1")
def a30_gene_coverage_matrix(spark, d):
    g = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("feature"), F.col("l_returnflag").alias("f")).agg(F.median("l_quantity").alias("depth"))
    return reports.filled(g, "feature", ["A", "N", "R"], "f", ["depth"])


@query("SELECT s_suppkey AS id, [r_name, CASE WHEN n_nationkey % 3 = 0 THEN '?' ELSE n_name END, '?'] AS lineage FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def s22_ranked_paths(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    taxa = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("id"), F.concat_ws(";", "r_name", "n_name", "s_name").alias("path"))
    nodes = n.selectExpr("concat_ws(';', r_name, n_name) as path", "if(n_nationkey % 3 = 0, 'subnation', 'nation') as rank").union(n.selectExpr("r_name as path", "'region' as rank").distinct())
    return annotation.ranked_paths(taxa, nodes, ("region", "nation", "genus"))


@query("SELECT p_partkey AS gene, p_type AS terms FROM part")
def s25_gene_functions(spark, d):
    p = table(spark, d, "part")
    return annotation.gene_functions({"KO": p.select("p_partkey", "p_type"), "COG": p.select("p_partkey", "p_brand")}, "KO")


@query("SELECT 's' || o_custkey AS sample, max(o_orderkey)::DOUBLE AS reads, max(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 100 + 0.5 END)::DOUBLE AS overall FROM orders GROUP BY 1")
def a41_log_table(spark, d):
    logs = table(spark, d, "orders").selectExpr("concat('s', o_custkey) as sample", "concat('a\n', o_orderkey, ' reads; of these:\n', if(o_orderkey % 2 = 0, concat(o_orderkey % 100, '.5% overall alignment rate\n'), '')) as text")
    return reports.log_table(logs, "sample", "text", {k: reports.LOG_PATTERNS[k] for k in ("reads", "overall")})


@query("SELECT l_returnflag AS category, string_agg(DISTINCT l_suppkey || '|' || l_partkey, chr(9) ORDER BY l_suppkey || '|' || l_partkey) AS line FROM lineitem GROUP BY 1")
def x20_category_lines(spark, d):
    return reports.category_lines(table(spark, d, "lineitem").withColumnRenamed("l_returnflag", "category"), "category", "l_suppkey", "l_partkey")


@query("""
WITH x AS (SELECT l_orderkey AS q, [r_name, n_name, CAST(s_suppkey AS VARCHAR)] AS g, 100 - 100 * l_discount AS p, l_quantity AS l FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE l_quantity >= 0.6 * 30 AND l_quantity >= 20),
b AS (SELECT *, max(p) OVER (PARTITION BY q) AS best, max(l) OVER (PARTITION BY q) AS ml FROM x),
k AS (SELECT * FROM b WHERE l >= 0.85 * ml AND p >= best - CASE WHEN best >= 100 THEN 0.1 WHEN best >= 99.5 THEN 0.25 WHEN best >= 99 THEN 0.5 WHEN best >= 98 THEN 1.0 WHEN best >= 97 THEN 1.25 ELSE 1.5 END),
n AS (SELECT q, count(*) AS n, max(1 + (best >= 85)::INT + (best >= 88)::INT + (best >= 91)::INT + (best >= 93)::INT + (best >= 95)::INT + (best >= 97)::INT) AS deep FROM k GROUP BY 1),
v AS (SELECT q, CAST(i AS INTEGER) AS level, array_to_string(g[1:i], ';') AS name, count(*) AS v FROM k, range(1, 4) t(i) GROUP BY ALL)
SELECT q AS l_orderkey, max(level) AS level, arg_max(name, level) AS name FROM v JOIN n USING (q) WHERE v >= ceil(0.8 * n) AND level <= deep GROUP BY 1""")
def m17_covered_lca(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    s = table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.array("r_name", "n_name", F.col("s_suppkey").cast("string")).alias("lineage"))
    x = table(spark, d, "lineitem").join(s, "l_suppkey").select("l_orderkey", "lineage", (100 - 100 * F.col("l_discount")).alias("pident"), "l_quantity", F.lit(30).alias("query_len"))
    return taxonomy.deepest(taxonomy.covered_lca(x, "l_orderkey", "lineage", "pident", "l_quantity", "query_len", least=20), "l_orderkey")


@query("""
WITH b AS (SELECT p_brand || ';' || p_type || CASE WHEN p_size % 3 = 0 THEN '|' || p_brand || ';X' ELSE '' END || CASE WHEN p_size % 5 = 0 THEN ',Y' ELSE '' END AS t, l_returnflag AS sample, l_quantity AS v FROM lineitem JOIN part ON l_partkey = p_partkey),
a AS (SELECT sample, v, unnest(list_distinct(string_split(t, ','))) AS a FROM b), o AS (SELECT sample, v / len(list_distinct(string_split(a, '|'))) AS v, unnest(list_distinct(string_split(a, '|'))) AS o FROM a)
SELECT CAST(i - 1 AS INTEGER) AS level, array_to_string(string_split(o, ';')[1:i], ';') AS term, sample, round(sum(v), 4) AS value FROM o, range(1, 3) t(i) WHERE i <= len(string_split(o, ';')) GROUP BY ALL""")
def a11_term_levels(spark, d):
    terms = F.expr("concat(p_brand, ';', p_type, if(p_size % 3 = 0, concat('|', p_brand, ';X'), ''), if(p_size % 5 = 0, ',Y', ''))")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), terms.alias("terms"))
    x = table(spark, d, "lineitem").join(p, "l_partkey").select("terms", F.col("l_returnflag").alias("sample"), F.col("l_quantity").alias("value"))
    return matrix.roll_up_terms(x, "terms", "sample", "value").withColumn("value", F.round("value", 4))


@query("""
WITH m AS (SELECT DISTINCT p_brand AS module, p_size % 6 AS reaction, p_partkey % 150 AS feature FROM part), k AS (SELECT feature FROM m GROUP BY 1 HAVING count(DISTINCT module) > 12), f AS (SELECT * FROM m WHERE feature NOT IN (SELECT feature FROM k)),
a AS (SELECT l_partkey % 150 AS feature, l_suppkey AS sample, sum(l_quantity) AS value FROM lineitem WHERE l_linenumber > 5 GROUP BY ALL), s AS (SELECT module, count(DISTINCT reaction) AS n FROM f GROUP BY 1),
h AS (SELECT module, reaction, sample, sum(value) AS v FROM f JOIN a USING (feature) GROUP BY ALL), o AS (SELECT module, sample, count(*) AS k, avg(v) AS v FROM h GROUP BY ALL)
SELECT module, sample, round(k / n, 6) AS completeness, round(v, 4) AS score FROM o JOIN s USING (module) WHERE k / n >= 0.5""")
def a13_module_reactions(spark, d):
    members = table(spark, d, "part").selectExpr("p_brand as module", "p_size % 6 as reaction", "p_partkey % 150 as feature")
    abundance = table(spark, d, "lineitem").where("l_linenumber > 5").groupBy((F.col("l_partkey") % 150).alias("feature"), F.col("l_suppkey").alias("sample")).agg(F.sum("l_quantity").alias("value"))
    return matrix.module_reactions(abundance, members, redundancy=12).select("module", "sample", F.round("completeness", 6).alias("completeness"), F.round("score", 4).alias("score"))


@query("""
SELECT gene, event_id, CAST(CASE WHEN gene % 2 = 0 THEN e - event_id + 1 ELSE event_id - s + 1 END AS BIGINT) AS place
FROM (SELECT o_orderkey AS gene, o_custkey % 150 AS user_id, (o_orderkey * 7) % 9000 AS s, (o_orderkey * 7) % 9000 + o_orderkey % 400 AS e FROM orders) JOIN events USING (user_id) WHERE event_id BETWEEN s AND e""")
def j09_relative_places(spark, d):
    o = table(spark, d, "orders")
    genes = o.select(F.col("o_orderkey").alias("gene"), (F.col("o_custkey") % 150).alias("user_id"), ((F.col("o_orderkey") * 7) % 9000).alias("s")).withColumn("e", F.col("s") + F.col("gene") % 400)
    j = intervals.range_join(table(spark, d, "events").select("user_id", "event_id"), genes, ["user_id"], "event_id", "s", "e", 400)
    strand = F.when(F.col("gene") % 2 == 0, "-").otherwise("+")
    return j.select("gene", "event_id", intervals.relative_place(F.col("event_id"), F.col("s"), F.col("e"), strand).alias("place"))


@query("SELECT s_suppkey, 'n' || s_nationkey || CASE WHEN k > 1 THEN '_' || k ELSE '' END AS name FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS k FROM supplier)")
def f09_unique_names(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("name"))
    return sequence.unique_names(s, "name", "s_suppkey")
