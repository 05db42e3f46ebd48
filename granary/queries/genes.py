"""Gene, marker and read operators over proxies: a gene is a part, its group the brand, a sample the supplier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import genes, reports
from ..plans.registry import query, table

_OCC = "(SELECT p_brand AS g, p_partkey AS gene, count(*)::DOUBLE AS occ, (count(*) FILTER (l_linenumber = 1))::DOUBLE AS multi, 1 + p_size / 50.0::DOUBLE AS multibin, p_partkey % 20 = 0 AS is_marker FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, p_partkey, p_size) o"


def occurrences(spark, d) -> DataFrame:
    n = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").cast("double").alias("occ"), F.count_if(F.col("l_linenumber") == 1).cast("double").alias("multi"))
    p = table(spark, d, "part").selectExpr("p_brand as g", "p_partkey as gene", "1 + p_size / cast(50 as double) as multibin", "p_partkey % 20 = 0 as is_marker")
    return n.join(p, F.col("l_partkey") == F.col("gene")).select("g", "gene", "occ", "multi", "multibin", "is_marker")


@query(f"""
WITH k AS (SELECT * FROM {_OCC} WHERE is_marker OR (multi / occ < 0.1 AND multibin > 0.9 AND multibin < 3)), q AS (SELECT g, quantile_disc(occ, 0.1) AS lo, quantile_disc(occ, 0.9) AS hi FROM k GROUP BY 1)
SELECT g, gene FROM k JOIN q USING (g) WHERE is_marker OR (occ >= lo AND occ <= hi)""")
def p11_core_genes(spark, d):
    return genes.core_genes(occurrences(spark, d), "g").select("g", "gene")


@query(f"SELECT g, gene FROM {_OCC} WHERE is_marker OR (multibin > 0.9 AND occ >= 30)")
def p12_extended_core(spark, d):
    return occurrences(spark, d).where("is_marker or (multibin > 0.9 and occ >= 30)").select("g", "gene")


@query("""
WITH x AS (SELECT l_suppkey AS s, l_partkey AS gene, l_discount AS csp, CASE WHEN l_linenumber = 7 THEN 2 ELSE 1 END AS copies FROM lineitem),
r AS (SELECT s, count(*) FILTER (copies > 1) / count(*) AS dr, count(*) FILTER (csp > 0.09) / count(*) AS cr FROM x GROUP BY 1),
k AS (SELECT x.*, count(*) OVER (PARTITION BY s) AS n FROM x JOIN r USING (s) WHERE dr <= 0.2 AND cr < 0.12 AND csp <= 0.09 AND copies = 1) SELECT s, count(*) AS kept FROM k WHERE n >= 10 GROUP BY 1""")
def p14_conspecific_filter(spark, d):
    x = table(spark, d, "lineitem").selectExpr("l_suppkey as s", "l_partkey as gene", "l_discount as csp", "if(l_linenumber = 7, 2, 1) as copies")
    return genes.conspecific_free(x, "s", "gene", "csp", "copies", 0.09, 0.2, 0.12).groupBy("s").agg(F.count("*").alias("kept"))


@query()
def p17_read_quality(spark, d):
    x = table(spark, d, "documents").selectExpr("doc_id", "upper(translate(text, ' ', 'N')) as seq")
    return x.select("doc_id", genes.read_passes(F.col("seq"), F.col("seq"), ambiguous=60).alias("passes"))


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def p18_unassigned(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.array(F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).otherwise("?")).alias("lineage"))
    return genes.unassigned(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", a).select("o_orderkey")


@query("SELECT p_brand AS cluster, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def j08_member_to_cluster(spark, d):
    index = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("cluster"))
    return genes.to_clusters(table(spark, d, "lineitem").select("l_partkey"), index, "l_partkey").groupBy("cluster").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_mktsegment WHEN c_nationkey > 12 THEN c_name ELSE 'self' END AS name FROM customer")
def j16_lookup_cascade(spark, d):
    a, b = F.when(F.col("c_acctbal") > 5000, F.col("c_mktsegment")), F.when(F.col("c_nationkey") > 12, F.col("c_name")).otherwise("?")
    return table(spark, d, "customer").select("c_custkey", genes.first_known(a, b, F.lit("self")).alias("name"))


@query("""
WITH n AS (SELECT l_suppkey, l_returnflag AS c, count(DISTINCT l_partkey) AS k, string_agg(DISTINCT CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)) AS g FROM lineitem GROUP BY ALL)
SELECT l_suppkey, max(g) FILTER (c = 'A') AS "A", max(g) FILTER (c = 'N') AS "N", max(g) FILTER (c = 'R') AS "R", round(avg(k), 4) AS copies FROM n GROUP BY 1""")
def a28_markers_every_group(spark, d):
    return genes.marker_table(table(spark, d, "lineitem"), "l_suppkey", "l_returnflag", "l_partkey", ["A", "N", "R"])


@query("SELECT user_id, count(*) AS places, round(avg(value), 4) AS mean, median(value) AS median, round(count(*) FILTER (value > 0) / count(*), 4) AS covered FROM events GROUP BY 1")
def a34_coverage_summary(spark, d):
    return genes.coverage_summary(table(spark, d, "events"), ["user_id"], "value")


@query("SELECT l_orderkey, round(count(p_partkey) / count(*), 6) AS share FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 20) ON l_partkey = p_partkey GROUP BY 1 HAVING count(p_partkey) / count(*) >= 0.5")
def a48_contig_completeness(spark, d):
    m = table(spark, d, "part").where("p_size > 20").select(F.col("p_partkey").alias("l_partkey"))
    return genes.contig_completeness(table(spark, d, "lineitem").select("l_orderkey", "l_partkey"), "l_orderkey", "l_partkey", m).withColumn("share", F.round("share", 6))


@query("SELECT c_nationkey, c_name FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_acctbal > 9900 THEN 0 WHEN NOT starts_with(c_name, 'Customer#00000000') THEN 1 ELSE 2 END, c_name) AS k FROM customer) WHERE k = 1")
def w09_representative_member(spark, d):
    return genes.representative_member(table(spark, d, "customer"), "c_nationkey", "c_name", F.col("c_acctbal") > 9900, "Customer#00000000")


@query(f"""
WITH q AS (SELECT g, least(quantile_disc(multibin, 0.75), 2.2) AS q, avg(occ) AS a FROM {_OCC} GROUP BY 1), k AS (SELECT * FROM {_OCC} JOIN q USING (g) WHERE (is_marker AND multibin <= q) OR (NOT is_marker AND occ BETWEEN 0.5 * a AND 1.5 * a))
SELECT g, gene, CAST(row_number() OVER (PARTITION BY g ORDER BY is_marker DESC, occ DESC, gene) AS INTEGER) AS place FROM k""")
def w16_gene_ranking(spark, d):
    return genes.rank_genes(occurrences(spark, d), "g", "gene")


@query("""
SELECT s_suppkey AS id, [r_name, n_name, '?'] AS lineage FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def f25_ranked_lineage(spark, d):
    s = table(spark, d, "supplier").selectExpr("s_suppkey as id", "-1000 - s_nationkey as parent", "'strain' as rank", "s_name as name")
    n = table(spark, d, "nation").selectExpr("cast(-1000 - n_nationkey as bigint) as id", "-2000 - n_regionkey as parent", "'nation' as rank", "n_name as name")
    r = table(spark, d, "region").selectExpr("cast(-2000 - r_regionkey as bigint) as id", "-2000 - r_regionkey as parent", "'region' as rank", "r_name as name")
    return genes.lineage_from_parents(s.union(n).union(r), ("region", "nation", "genus"), 8).where("id >= 0")


@query("SELECT doc_id, substr(text, 11, 90) AS seq FROM documents WHERE n_chars >= 100")
def f29_genes_every_document(spark, d):
    docs = table(spark, d, "documents").where("n_chars >= 100")
    g = docs.selectExpr("doc_id", "concat('g', doc_id) as gene", "11 as start", "100 as end", "'+' as strand")
    return genes.extract_genes(docs.selectExpr("doc_id", "text as seq"), g, "doc_id").select("doc_id", "seq")


@query("""
WITH r AS (SELECT l_partkey AS gene, l_suppkey AS target, max(l_discount) AS r FROM lineitem GROUP BY ALL), t AS (SELECT *, max(r) OVER (PARTITION BY gene) AS m FROM r) SELECT gene, min(target) AS target FROM t WHERE r >= m - 0.015 GROUP BY 1""")
def m10_disentangled_genes(spark, d):
    r = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("gene"), F.col("l_suppkey").alias("target")).agg(F.max("l_discount").alias("r"))
    return genes.best_assignment(r, "gene", "target", "r", 0.015)


@query("""
WITH a AS (SELECT l_suppkey AS g, l_partkey AS gene, max(l_quantity) AS sa FROM lineitem WHERE l_linenumber <= 3 GROUP BY ALL), b AS (SELECT l_suppkey AS g, l_partkey AS gene, max(l_quantity) AS sb FROM lineitem WHERE l_linenumber >= 3 GROUP BY ALL)
SELECT coalesce(a.g, b.g) AS g, coalesce(a.gene, b.gene) AS gene FROM a FULL JOIN b ON a.g = b.g AND a.gene = b.gene WHERE (sa IS NOT NULL AND sb IS NOT NULL) OR greatest(sa, sb) >= 45
UNION SELECT l_suppkey, l_partkey FROM lineitem WHERE l_partkey % 100 = 0""")
def u03_cluster_union(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("g"), F.col("l_partkey").alias("gene"), F.col("l_quantity").alias("score"), "l_linenumber")
    a, b = (li.where(c).groupBy("g", "gene").agg(F.max("score").alias("score")) for c in ("l_linenumber <= 3", "l_linenumber >= 3"))
    return genes.cluster_union(a, b, "g", "gene", 45, li.where("gene % 100 = 0"))


@query("SELECT l_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE 100 - 100 * l_discount > 95 GROUP BY 1 HAVING sum(l_quantity) >= 0.8 * max(o_custkey % 200)")
def x13_covered_contigs(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 200).alias("len"))
    h = table(spark, d, "lineitem").join(o, "l_orderkey").withColumn("pid", 100 - 100 * F.col("l_discount"))
    return genes.covered_by_hits(h, "l_orderkey", "len", "l_quantity", "pid")


@query("""
WITH e AS (SELECT label, unnest(range(0, 64)) AS i, abs(unnest(embedding)::DOUBLE) AS x FROM embeddings), s AS (SELECT label, i, sum(x) AS s FROM e GROUP BY ALL)
SELECT label, CAST(i AS INTEGER) AS i, round(100.0::DOUBLE * s / sum(s) OVER (PARTITION BY label), 3) AS value FROM s""")
def x06_kmer_profiles(spark, d):
    e = table(spark, d, "embeddings").select("label", F.transform("embedding", lambda x: F.abs(x.cast("double"))).alias("v"))
    return genes.shared_vectors(e, "label", "v")


@query("""
SELECT 'lineitem' AS report, l_suppkey AS id, count(*) AS n, round(sum(l_quantity), 4) AS total, NULL::DOUBLE AS balance FROM lineitem GROUP BY 2
UNION ALL SELECT 'orders', o_custkey, count(*), round(sum(o_totalprice), 4), NULL FROM orders GROUP BY 2 UNION ALL SELECT 'customer', c_custkey, NULL, NULL, c_acctbal FROM customer""")
def a40_summaries(spark, d):
    li = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 4).alias("total"))
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 4).alias("total"))
    c = table(spark, d, "customer").selectExpr("c_custkey as id", "c_acctbal as balance")
    return reports.union_summaries({"lineitem": li, "orders": o, "customer": c}, "report")


@query("""
WITH n AS (SELECT r_name || ';' || n_name || ';' || c_mktsegment AS lineage, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1)
SELECT lineage, n, row_number() OVER (ORDER BY n DESC, lineage) AS place FROM n""")
def a46_frequency_list(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat_ws(";", "r_name", "n_name", "c_mktsegment").alias("lineage"))
    return reports.frequency_list(c, "lineage")
