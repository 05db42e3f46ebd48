"""Hits, taxonomy and bins over proxies.

A hit's query is an order, its subject a part, bits the extended price, identity 100 - 100 * discount, length the quantity; a lineage is region, nation,
segment; a bin's completeness and contamination are a document's length and label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators import assembly, bins, hits, taxonomy
from ..plans.registry import query, table

_HITS = "(SELECT l_orderkey AS query, l_partkey AS subject, 100 - 100 * l_discount AS pident, l_quantity AS aln_len, l_tax AS evalue, l_extendedprice AS bitscore, CAST(l_suppkey AS INTEGER) AS qs, CAST(l_suppkey + l_quantity AS INTEGER) AS qe, l_linenumber FROM lineitem) h"


def hit_table(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").selectExpr("l_orderkey as query", "l_partkey as subject", "100 - 100 * l_discount as pident", "l_quantity as aln_len", "l_tax as evalue", "l_extendedprice as bitscore", "cast(l_suppkey as int) as qs", "cast(l_suppkey + l_quantity as int) as qe", "l_linenumber")


@query(f"SELECT count(*) AS n, count(*) FILTER (aln_len >= 0.1 * p_size AND aln_len >= 0.7 * 30 AND pident >= 0.985 * 97) AS passed FROM {_HITS} JOIN part ON subject = p_partkey")
def p02_hit_predicate(spark, d):
    h = hit_table(spark, d).join(table(spark, d, "part").select(F.col("p_partkey").alias("subject"), "p_size"), "subject")
    return h.agg(F.count("*").alias("n"), F.count_if(hits.passes(F.col("aln_len"), F.col("p_size"), F.lit(30), F.col("pident"), 97.0)).alias("passed"))


@query(f"SELECT query, subject, bitscore FROM {_HITS} WHERE evalue <= 0.02 AND bitscore >= 20000 AND aln_len >= 20 AND pident >= 95")
def p03_hit_acceptance(spark, d):
    return hits.accept(hit_table(spark, d), 0.02, 20000, 20, 95).select("query", "subject", "bitscore")


@query(f"SELECT min_id, max_evalue, count(*) AS n FROM {_HITS} JOIN (VALUES (0.02::DOUBLE, 95.0::DOUBLE), (0.05, 92.0)) t(max_evalue, min_id) ON evalue <= max_evalue AND pident >= min_id GROUP BY ALL")
def a03_hit_thresholds(spark, d):
    t = spark.createDataFrame([(0.02, 95.0), (0.05, 92.0)], "max_evalue double, min_id double")
    return hits.by_thresholds(hit_table(spark, d), t).groupBy("min_id", "max_evalue").agg(F.count("*").alias("n"))


@query(f"SELECT query, subject, bitscore FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY bitscore DESC, evalue, subject) AS k FROM {_HITS}) WHERE k = 1")
def w07_best_hit(spark, d):
    return hits.best_hit(hit_table(spark, d), ["query"]).select("query", "subject", "bitscore")


@query(f"SELECT query, subject, max(bitscore) AS bitscore FROM {_HITS} GROUP BY ALL")
def w08_best_per_pair(spark, d):
    return hits.best_hit(hit_table(spark, d), ["query", "subject"]).select("query", "subject", "bitscore")


@query("""
SELECT l_orderkey AS gene, min(l_partkey % 5) AS cog, max(l_quantity) AS bits FROM (SELECT *, rank() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC) AS k FROM lineitem) WHERE k = 1
GROUP BY 1 HAVING min(l_partkey % 5) = max(l_partkey % 5)""")
def w06_unambiguous_best(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("gene"), (F.col("l_partkey") % 5).alias("cog"), F.col("l_quantity").alias("bits"))
    return hits.drop_ambiguous(x, "gene", "cog", "bits")


@query(f"""
WITH f AS (SELECT *, l_linenumber % 2 AS mate, row_number() OVER (PARTITION BY query, subject, l_linenumber % 2 ORDER BY bitscore DESC, evalue, qs, qe) AS k FROM (SELECT query, subject % 50 AS subject, pident, aln_len, evalue, bitscore, qs, qe, l_linenumber FROM {_HITS})),
j AS (SELECT x.query, x.subject, (x.pident + y.pident) / 2 AS pident, x.aln_len + y.aln_len AS t, greatest(0, least(x.qe, y.qe) - greatest(x.qs, y.qs) + 1) AS o, least(x.evalue, y.evalue) AS evalue, x.bitscore + y.bitscore AS b
  FROM f x JOIN f y ON x.query = y.query AND x.subject = y.subject AND x.mate = 1 AND y.mate = 0 AND x.k = 1 AND y.k = 1)
SELECT query, subject, round(pident, 6) AS pident, t - o AS aln_len, evalue, round(b * (t - o) / t, 5) AS bitscore FROM j""")
def j05_mate_merge(spark, d):
    h = hit_table(spark, d).withColumn("subject", F.col("subject") % 50)
    m = hits.merge_mates(h.where("l_linenumber % 2 = 1"), h.where("l_linenumber % 2 = 0"))
    return m.withColumn("pident", F.round("pident", 6)).withColumn("bitscore", F.round("bitscore", 5))


_NEAR = "(x.p >= a.p - 5 AND x.l >= 0.97 * a.l AND x.b > 1.03 * a.b) OR (x.p > a.p AND x.l > 0.92 * a.l AND x.b > 0.9 * a.b) OR (x.l > 1.15 * a.l AND x.p >= a.p - 5 AND x.b > 0.9 * a.b)"


@query(f"""
WITH h AS (SELECT query, list({{'p': pident, 'l': aln_len, 'b': bitscore, 's': subject, 'e': evalue}} ORDER BY bitscore DESC, evalue, subject, pident, aln_len) AS h FROM {_HITS} GROUP BY 1),
f AS (SELECT query, list_reduce(h, lambda a, x: CASE WHEN {_NEAR} THEN x ELSE a END) AS f FROM h) SELECT query, f.s AS subject, f.p AS pident, f.l AS aln_len, f.e AS evalue, f.b AS bitscore FROM f""")
def w04_ordered_fold(spark, d):
    return hits.fold_best(hit_table(spark, d), "query")


@query("""
WITH c AS (SELECT p_partkey, unnest(list_distinct(string_split(p_name, ' '))) AS category, p_size FROM part),
s AS (SELECT l_returnflag AS kingdom, category, sum(CASE WHEN l_linenumber = 1 THEN 2 ELSE 1 END)::DOUBLE AS cnt, sum(CASE WHEN l_linenumber = 1 THEN 2 ELSE 1 END * l_quantity / p_size) AS gln FROM lineitem JOIN c ON l_partkey = p_partkey GROUP BY ALL)
SELECT 'cnt' AS norm, kingdom, category, round(cnt, 5) AS value FROM s UNION ALL SELECT 'GLN', kingdom, category, round(gln, 5) FROM s""")
def a02_function_abundance(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("subject"), F.col("l_returnflag").alias("kingdom"), F.col("l_quantity").alias("aln_len"), "l_linenumber")
    anno = table(spark, d, "part").select(F.col("p_partkey").alias("subject"), F.translate("p_name", " ", ",").alias("categories"), F.col("p_size").alias("subject_len"))
    return hits.function_abundance(li, anno, F.col("l_linenumber") == 1).withColumn("value", F.round("value", 5))


@query("""
WITH s AS (SELECT l_returnflag AS marker, l_extendedprice AS score, l_quantity > 25 AS t, floor(min(l_extendedprice) OVER (PARTITION BY l_returnflag)) AS low FROM lineitem),
c AS (SELECT marker, CAST(low + 1000 * floor((score - low) / 1000) AS BIGINT) AS cutoff, count(*) FILTER (t) AS tr, count(*) FILTER (NOT t) AS fa FROM s GROUP BY ALL),
r AS (SELECT marker, cutoff, sum(tr) OVER w AS tp, sum(fa) OVER w AS fp, sum(tr) OVER (PARTITION BY marker) AS al FROM c WINDOW w AS (PARTITION BY marker ORDER BY cutoff DESC ROWS UNBOUNDED PRECEDING))
SELECT marker, cutoff, tp / (tp + fp) AS precision, tp / al AS recall FROM r WHERE al > 0 QUALIFY row_number() OVER (PARTITION BY marker ORDER BY CASE WHEN tp > 0 THEN 2.0::DOUBLE * tp / (tp + fp + al) ELSE 0 END DESC, cutoff DESC) = 1""")
def x01_cutoff_calibration(spark, d):
    s = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("marker"), F.col("l_extendedprice").alias("score"), (F.col("l_quantity") > 25).alias("is_true"))
    return hits.calibrate_cutoffs(s, 1000)


@query("SELECT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 40")
def j01_inner_annotation(spark, d):
    return table(spark, d, "lineitem").join(table(spark, d, "part").where("p_size > 40"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand")


@query("SELECT l_orderkey, coalesce(p_brand, '?') AS brand, count(*) AS n FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 40) ON l_partkey = p_partkey GROUP BY ALL")
def j02_left_with_default(spark, d):
    j = table(spark, d, "lineitem").join(table(spark, d, "part").where("p_size > 40"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return j.groupBy("l_orderkey", F.coalesce("p_brand", F.lit("?")).alias("brand")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def j03_semi_join(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders").where("o_totalprice > 300000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def j04_anti_join(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query(f"SELECT query, subject, sum(bitscore) AS bits, sum(aln_len) AS aln_len, round(avg(pident), 6) AS pident FROM {_HITS} GROUP BY ALL")
def j06_mates_every_query(spark, d):
    return hit_table(spark, d).groupBy("query", "subject").agg(F.sum("bitscore").alias("bits"), F.sum("aln_len").alias("aln_len"), F.round(F.avg("pident"), 6).alias("pident"))


@query("""
WITH s AS (SELECT DISTINCT l_suppkey % 20 AS a, l_partkey AS i FROM lineitem), c AS (SELECT DISTINCT o_custkey % 20 AS b, l_partkey AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
p AS (SELECT a, b, count(*) AS shared FROM s JOIN c USING (i) GROUP BY ALL), na AS (SELECT a, count(*) AS n FROM s GROUP BY 1), nb AS (SELECT b, count(*) AS n FROM c GROUP BY 1)
SELECT a, b, shared, round(shared / na.n, 6) AS share_a, round(shared / nb.n, 6) AS share_b FROM p JOIN na USING (a) JOIN nb USING (b)""")
def j14_set_overlaps(spark, d):
    o = bins.overlaps(*_sets(spark, d), "a", "b", "i")
    return o.withColumn("share_a", F.round("share_a", 6)).withColumn("share_b", F.round("share_b", 6))


def _sets(spark, d):
    li = table(spark, d, "lineitem")
    a = li.select((F.col("l_suppkey") % 20).alias("a"), F.col("l_partkey").alias("i"))
    b = li.join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select((F.col("o_custkey") % 20).alias("b"), F.col("l_partkey").alias("i"))
    return a, b


@query("""
WITH s AS (SELECT DISTINCT l_suppkey % 20 AS a, l_partkey AS i FROM lineitem), c AS (SELECT DISTINCT o_custkey % 20 AS b, l_partkey AS i FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
p AS (SELECT a, b, count(*) AS shared FROM s JOIN c USING (i) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY shared DESC, b) AS ka, row_number() OVER (PARTITION BY b ORDER BY shared DESC, a) AS kb FROM p)
SELECT a, b, shared FROM r WHERE ka = 1 AND kb = 1""")
def j13_reciprocal_best(spark, d):
    return bins.reciprocal_best(bins.overlaps(*_sets(spark, d), "a", "b", "i"), "a", "b").select("a", "b", "shared")


@query("""
WITH o AS (SELECT DISTINCT l_suppkey % 20 AS a, l_partkey AS i FROM lineitem WHERE l_linenumber <= 3), n AS (SELECT DISTINCT l_suppkey % 20 AS a, l_partkey AS i FROM lineitem WHERE l_linenumber >= 3)
SELECT coalesce(o.a, n.a) AS a, count(*) FILTER (o.a IS NOT NULL AND n.a IS NOT NULL) AS both, count(*) FILTER (o.a IS NULL) AS only_new, count(*) FILTER (n.a IS NULL) AS only_old FROM o FULL JOIN n ON o.a = n.a AND o.i = n.i GROUP BY 1""")
def u02_set_change(spark, d):
    li = table(spark, d, "lineitem").select((F.col("l_suppkey") % 20).alias("a"), F.col("l_partkey").alias("i"), "l_linenumber")
    return bins.set_change(li.where("l_linenumber <= 3"), li.where("l_linenumber >= 3"), "a", "i")


@query("""
WITH x AS (SELECT c.c_custkey AS c, r_name, n_name, c_mktsegment, o_orderpriority AS g FROM customer c JOIN orders ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
n AS (SELECT g, r_name, count(*) AS v, sum(count(*)) OVER (PARTITION BY g) AS t FROM x GROUP BY g, r_name)
SELECT g, 'r' AS rank, CASE WHEN t >= 100 AND v > 0.2 * t THEN r_name ELSE '?' END AS name FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY v DESC, r_name DESC) AS k FROM n) WHERE k = 1""")
def a20_majority(spark, d):
    return taxonomy.majority(_lineages(spark, d).select(F.col("o_orderpriority").alias("g"), F.lit("r").alias("rank"), F.col("lineage")[0].alias("r")), "g", "rank", "r", share=0.2)


def _lineages(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    s = table(spark, d, "supplier").join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 nations
    s = s.select(F.col("s_suppkey").alias("l_suppkey"), F.array("r_name", "n_name", F.col("s_suppkey").cast("string")).alias("lineage"))
    c = table(spark, d, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("o_custkey"), F.array("r_name", "n_name", "c_mktsegment").alias("lineage"))
    return table(spark, d, "orders").join(c, "o_custkey").select("o_orderkey", "o_orderpriority", "o_custkey", "lineage")


@query("""
WITH x AS (SELECT l_orderkey, r_name AS a, r_name || ';' || n_name AS b FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
t AS (SELECT l_orderkey, count(*) AS n FROM x GROUP BY 1), v1 AS (SELECT l_orderkey, a, count(*) AS v FROM x GROUP BY ALL), v2 AS (SELECT l_orderkey, b, count(*) AS v FROM x GROUP BY ALL)
SELECT l_orderkey, CAST(1 AS INTEGER) AS level, a AS name, v AS votes, n FROM v1 JOIN t USING (l_orderkey) WHERE v >= ceil(0.9 * n)
UNION ALL SELECT l_orderkey, 2, b, v, n FROM v2 JOIN t USING (l_orderkey) WHERE v >= ceil(0.9 * n)""")
def m16_lineage_vote(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    s = table(spark, d, "supplier").join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.array("r_name", "n_name").alias("lineage"))
    x = table(spark, d, "lineitem").join(s, "l_suppkey").select("l_orderkey", "lineage")
    return taxonomy.vote(x, "l_orderkey", "lineage", 2)


@query("""
WITH x AS (SELECT l_orderkey AS q, [r_name, n_name, CAST(s_suppkey AS VARCHAR)] AS g, 100 - 100 * l_discount AS p, l_quantity AS l FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
b AS (SELECT *, max(p) OVER (PARTITION BY q) AS best, max(l) OVER (PARTITION BY q) AS ml FROM x),
k AS (SELECT * FROM b WHERE l >= 0.85 * ml AND p >= best - CASE WHEN best >= 100 THEN 0.1 WHEN best >= 99.5 THEN 0.25 WHEN best >= 99 THEN 0.5 WHEN best >= 98 THEN 1.0 WHEN best >= 97 THEN 1.25 ELSE 1.5 END),
n AS (SELECT q, count(*) AS n, max(1 + (best >= 85)::INT + (best >= 88)::INT + (best >= 91)::INT + (best >= 93)::INT + (best >= 95)::INT + (best >= 97)::INT) AS deep FROM k GROUP BY 1),
v AS (SELECT q, CAST(i AS INTEGER) AS level, array_to_string(g[1:i], ';') AS name, count(*) AS v FROM k, range(1, 4) t(i) GROUP BY ALL)
SELECT q AS l_orderkey, max(level) AS level, arg_max(name, level) AS name FROM v JOIN n USING (q) WHERE v >= ceil(0.9 * n) AND level <= deep GROUP BY 1""")
def m16_lca(spark, d):
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    s = table(spark, d, "supplier").join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.array("r_name", "n_name", F.col("s_suppkey").cast("string")).alias("lineage"))
    x = table(spark, d, "lineitem").join(s, "l_suppkey").select("l_orderkey", "lineage", (100 - 100 * F.col("l_discount")).alias("pident"), "l_quantity")
    return taxonomy.deepest(taxonomy.lca(x, "l_orderkey", "lineage", "pident", "l_quantity"), "l_orderkey")


@query("""
WITH x AS (SELECT o_orderpriority AS g, r_name, n_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
m AS (SELECT g, 0 AS k, max(v) / sum(v) AS s FROM (SELECT g, r_name, count(*) AS v FROM x GROUP BY ALL) GROUP BY 1 UNION ALL SELECT g, 1, max(v) / sum(v) FROM (SELECT g, n_name, count(*) AS v FROM x GROUP BY ALL) GROUP BY 1
  UNION ALL SELECT g, 2, max(v) / sum(v) FROM (SELECT g, c_mktsegment, count(*) AS v FROM x GROUP BY ALL) GROUP BY 1)
SELECT g, round(sum((3 - k) * s) / sum(3 - k), 10) AS score FROM m GROUP BY 1""")
def a21_congruence(spark, d):
    x = _lineages(spark, d).select(F.col("o_orderpriority").alias("g"), "lineage")
    return taxonomy.congruence(x, "g", "lineage", 3).withColumn("score", F.round("score", 10))


@query("""
WITH n AS (SELECT l_suppkey AS g, l_returnflag AS t, count(*) AS hits FROM lineitem GROUP BY ALL), r AS (SELECT *, row_number() OVER w AS k, coalesce(lead(hits) OVER w, 0) AS nx, sum(hits) OVER (PARTITION BY g) AS al FROM n WINDOW w AS (PARTITION BY g ORDER BY hits DESC, t))
SELECT g, t, hits, hits < 0.6 * al AS chimeric FROM r WHERE k = 1 AND hits > 5 AND nx <= 0.6 * hits""")
def a19_vote_assignment(spark, d):
    v = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("g"), F.col("l_returnflag").alias("t"))
    return taxonomy.assign_by_votes(v, "g", "t", runner_up=0.6)


_BINS = "(SELECT d.doc_id, d.source, d.lang, least(100, d.n_chars / 50.0)::DOUBLE AS compl, coalesce(l.toxic, 0) * 10.0::DOUBLE + d.doc_id % 7 AS conta FROM documents d LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id) b"


def bin_table(spark, d):
    lab = table(spark, d, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars").join(lab, "doc_id", "left")
    return docs.selectExpr("doc_id", "source", "lang", "least(100, n_chars / cast(50 as double)) as compl", "coalesce(toxic, 0) * cast(10 as double) + doc_id % 7 as conta")


@query(f"SELECT doc_id, compl, conta FROM {_BINS} WHERE compl > 50 AND conta <= 5")
def p06_quality_pass(spark, d):
    return bins.quality(bin_table(spark, d), 50, 5).select("doc_id", "compl", "conta")


@query(f"SELECT doc_id FROM {_BINS} WHERE NOT (compl > 50 AND conta <= 5)")
def p05_quality_fail(spark, d):
    return bins.quality(bin_table(spark, d), 50, 5, failing=True).select("doc_id")


@query(f"SELECT source, doc_id, compl - 2 * conta AS score FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY compl - 2 * conta DESC, doc_id) AS k FROM {_BINS} WHERE compl > 60 AND conta < 20) WHERE k = 1")
def w10_representatives(spark, d):
    return bins.representative(bin_table(spark, d), ["source"], "doc_id")


@query(f"SELECT count(*) FILTER (compl > 99) AS compl_gt_99, count(*) FILTER (compl > 95) AS compl_gt_95, count(*) FILTER (compl > 90) AS compl_gt_90, count(*) FILTER (compl > 80) AS compl_gt_80, count(*) FILTER (compl > 60) AS compl_gt_60 FROM {_BINS}")
def a25_quality_histogram(spark, d):
    return bins.histogram(bin_table(spark, d), "compl", (99, 95, 90, 80, 60))


@query("""
WITH e AS (SELECT DISTINCT l_suppkey AS g, l_partkey AS i FROM lineitem), k AS (SELECT i, count(*) AS k FROM e GROUP BY 1) SELECT g, round(count(*) / sum(k), 6) AS uniqueness FROM e JOIN k USING (i) GROUP BY 1""")
def a26_uniqueness(spark, d):
    e = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("g"), F.col("l_partkey").alias("i"))
    return bins.uniqueness(e, "g", "i").withColumn("uniqueness", F.round("uniqueness", 6))


@query("""
WITH e AS (SELECT l_suppkey AS g, l_returnflag AS i, count(*) AS n FROM lineitem GROUP BY ALL), o AS (SELECT l_suppkey AS g, count(*) AS obs FROM lineitem GROUP BY 1) SELECT g, i, round(n / obs, 6) AS share FROM e JOIN o USING (g) WHERE n / obs > 0.5""")
def m13_declutter(spark, d):
    li = table(spark, d, "lineitem")
    e = li.groupBy(F.col("l_suppkey").alias("g"), F.col("l_returnflag").alias("i")).agg(F.count("*").alias("n"))
    return bins.declutter(e, "g", "i", "n", li.groupBy(F.col("l_suppkey").alias("g")).agg(F.count("*").alias("obs")), 0.5).withColumn("share", F.round("share", 6))


@query()
def m12_greedy_groups(spark, d):
    li = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    x = li.select(F.col("s_nationkey").alias("block"), F.col("l_suppkey").alias("name"), (F.col("l_partkey") % 30).alias("item"), F.col("s_acctbal").alias("score"))
    return bins.greedy_groups(x, "block", "name", "item", "score")


@query()
def m14_canopies(spark, d):
    e = table(spark, d, "embeddings").where("embedding is not null").select("label", "vec_id", "embedding")
    return bins.canopies(e, "label", "vec_id", "embedding", 0.5)


@query()
def m09_multi_copy(spark, d):
    e = table(spark, d, "embeddings").where("embedding is not null")
    x = e.select(F.col("label").alias("species"), F.when(F.col("vec_id") % 3 == 0, F.col("vec_id") % 50).otherwise(F.col("vec_id") + 1000).alias("cog"), F.col("vec_id").alias("gene"), "embedding")
    return bins.resolve_multi_copy(x, "species", "cog", "gene", "embedding", 0.0)


@query("SELECT source, arg_max(doc_id, n_chars * 1000000000 - doc_id) AS doc_id FROM documents GROUP BY 1")
def w13_longest_per_category(spark, d):
    return hits.best_hit(table(spark, d, "documents").select("source", "doc_id", "n_chars"), ["source"], [F.desc("n_chars"), F.asc("doc_id")]).select("source", "doc_id")


@query("SELECT source, arg_min(doc_id, abs(1580 - n_chars) * 1000000000 + doc_id) AS doc_id FROM documents GROUP BY 1")
def w14_nearest_length(spark, d):
    return hits.best_hit(table(spark, d, "documents").select("source", "doc_id", "n_chars"), ["source"], [F.abs(1580 - F.col("n_chars")), F.asc("doc_id")]).select("source", "doc_id")


@query("""
SELECT user_id, event_id FROM (SELECT *, quantile_disc(value, 0.1) OVER (PARTITION BY user_id) AS lo, quantile_disc(value, 0.9) OVER (PARTITION BY user_id) AS hi FROM events) WHERE value > 0.9 * lo AND value < 1.1 * hi""")
def p13_abundance_band(spark, d):
    e = table(spark, d, "events")
    q = e.groupBy("user_id").agg(F.expr("percentile_disc(0.1) within group (order by value)").alias("lo"), F.expr("percentile_disc(0.9) within group (order by value)").alias("hi"))
    return e.join(q, "user_id").where("value > 0.9 * lo and value < 1.1 * hi").select("user_id", "event_id")


@query("SELECT DISTINCT l_suppkey, l_partkey FROM lineitem")
def u01_distinct(spark, d):
    return table(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()


@query("SELECT c_nationkey AS k, 'c' AS kind, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT s_nationkey, 's', count(*) FROM supplier GROUP BY 1")
def u04_union_all(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("c"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("s"))
    return c.unionByName(s)


@query("SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS place FROM documents")
def l01_longest_first(spark, d):
    return assembly.numbered(table(spark, d, "documents").select("doc_id", "n_chars"), -F.col("n_chars"), ["doc_id"], "place")


@query("SELECT l_suppkey, 'MGS.' || row_number() OVER (ORDER BY count(*) DESC, l_suppkey) AS name FROM lineitem GROUP BY 1")
def w15_names_by_observation(spark, d):
    n = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return assembly.numbered(n, -F.col("n"), ["l_suppkey"], "place").select("l_suppkey", F.concat(F.lit("MGS."), F.col("place").cast("string")).alias("name"))


@query("SELECT doc_id, n_chars, n_chars >= 2000 AS long FROM documents WHERE n_chars >= 500")
def p08_length_filter(spark, d):
    return table(spark, d, "documents").where("n_chars >= 500").select("doc_id", "n_chars", (F.col("n_chars") >= 2000).alias("long"))


@query("SELECT l_suppkey, list_sort(list(DISTINCT l_partkey)) AS members, len(list(DISTINCT l_partkey)) AS n FROM lineitem GROUP BY 1")
def s10_cluster_members(spark, d):
    m = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sort_array(F.collect_set("l_partkey")).alias("members"))
    return m.withColumn("n", F.size("members").cast("long"))


@query("SELECT CAST(row_number() OVER (ORDER BY s_suppkey) AS INTEGER) + 100 AS id, s_suppkey FROM supplier")
def u06_renumber(spark, d):
    s = assembly.numbered(table(spark, d, "supplier"), F.floor(F.col("s_suppkey") / 1000), ["s_suppkey"], "place")
    return s.select((F.col("place") + 100).cast("int").alias("id"), "s_suppkey")
