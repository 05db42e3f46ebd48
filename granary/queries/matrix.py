"""Matrices, roll-ups, statistics, lengths and intervals over proxies.

A feature's lineage is part type, brand and name; a sample is the supplier's nation; a value is the quantity sold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import stats
from ..operators import assembly, intervals, matrix
from ..plans.registry import query, table


def sales(spark: SparkSession, d: str) -> DataFrame:
    """lineage, nation, l_quantity: a part's and supplier's keys are unique, and lineitem is summed by both first."""
    n = table(spark, d, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("q"))
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.array("p_type", "p_brand", "p_name").alias("lineage"), "p_type", "p_brand", "p_name")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    return n.join(p, "l_partkey").join(s, "l_suppkey")


_SALES = "(SELECT l_partkey, l_suppkey, l_quantity AS q, p_type, p_brand, p_name, s_nationkey AS nation FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey) t"


@query(f"""
SELECT CAST(1 AS INTEGER) AS level, p_type AS feature, nation, sum(q) AS value FROM {_SALES} GROUP BY ALL
UNION ALL SELECT 2, p_type || ';' || p_brand, nation, sum(q) FROM {_SALES} GROUP BY ALL
UNION ALL SELECT 3, p_type || ';' || p_brand || ';' || p_name, nation, sum(q) FROM {_SALES} GROUP BY ALL""")
def a06_lineage_rollup(spark, d):
    return matrix.roll_up(sales(spark, d), "lineage", "nation", "q")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL")
def a01_group_counts(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("""
SELECT t AS threshold, l_returnflag, count(*) AS n, sum(l_quantity) AS quantity
FROM lineitem JOIN (VALUES (10), (25), (40)) v(t) ON l_quantity >= t GROUP BY ALL""")
def a03_multi_threshold(spark, d):
    t = spark.createDataFrame([(10,), (25,), (40,)], "threshold int")
    j = table(spark, d, "lineitem").join(F.broadcast(t), F.col("l_quantity") >= F.col("threshold"))
    return j.groupBy("threshold", "l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query(f"SELECT p_type, coalesce(CAST(nation AS VARCHAR), 'ALL') AS nation, sum(q) AS value FROM {_SALES} GROUP BY GROUPING SETS ((p_type, nation), (p_type))")
def a04_sample_merge(spark, d):
    s = sales(spark, d).groupBy("p_type", "nation").agg(F.sum("q").alias("q")).rollup("p_type", "nation").agg(F.sum("q").alias("value"), F.grouping("p_type").alias("g"))
    return s.where("g = 0").select("p_type", F.coalesce(F.col("nation").cast("string"), F.lit("ALL")).alias("nation"), "value")


@query("""
SELECT level, term, sum(w) AS value FROM (
  SELECT unnest([1, 2, 3]) AS level, unnest([c_mktsegment, 'n' || c_nationkey, CASE WHEN c_acctbal < 0 THEN 'debt' ELSE 'credit' END]) AS term, CASE WHEN c_custkey % 2 = 0 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM customer)
GROUP BY ALL""")
def a05_category_levels(spark, d):
    c = table(spark, d, "customer")
    levels = F.array(F.col("c_mktsegment"), F.concat(F.lit("n"), F.col("c_nationkey")), F.when(F.col("c_acctbal") < 0, "debt").otherwise("credit"))
    each = c.select(F.posexplode(levels).alias("level", "term"), F.when(F.col("c_custkey") % 2 == 0, 2.0).otherwise(1.0).alias("w"))
    return each.groupBy((F.col("level") + 1).alias("level"), "term").agg(F.sum("w").alias("value"))


@query("""
SELECT r_name || ';' || n_name || ';' || CASE WHEN c_acctbal < 0 THEN '?' ELSE c_mktsegment END || ';?' AS lineage, count(*) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def a08_padded_lineages(spark, d):
    from ..functions.sequence import pad_lineage

    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, d, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 nations
    ranks = F.array("r_name", "n_name", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))
    return c.select(F.array_join(pad_lineage(ranks, 4), ";").alias("lineage")).groupBy("lineage").agg(F.count("*").alias("n"))


@query(f"SELECT p_brand AS cluster, nation AS sample, sum(q) AS value FROM {_SALES} GROUP BY ALL")
def a10_cluster_matrix(spark, d):
    return sales(spark, d).groupBy(F.col("p_brand").alias("cluster"), F.col("nation").alias("sample")).agg(F.sum("q").alias("value"))


@query("""
SELECT term, sum(w) AS value, sum(w / k) AS shared FROM (
  SELECT l_quantity AS w, unnest(string_split(p_name, ' ')) AS term, len(string_split(p_name, ' ')) AS k FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY ALL""")
def a11_annotation_fan_out(spark, d):
    q = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    x = matrix.fan_out(q.join(p, "l_partkey").groupBy("p_name").agg(F.sum("q").alias("q")), "p_name", " ", share=True)
    return x.groupBy(F.col("p_name").alias("term")).agg(F.sum("q").alias("value"), F.sum(F.col("q") * F.col("weight")).alias("shared"))


@query(f"""
SELECT p_brand AS feature, nation AS sample, round(sum(q) / sum(sum(q)) OVER (PARTITION BY nation), 6) AS value FROM {_SALES} GROUP BY p_brand, nation""")
def a12_normalize(spark, d):
    m = sales(spark, d).groupBy(F.col("p_brand").alias("feature"), F.col("nation").alias("sample")).agg(F.sum("q").alias("value"))
    return matrix.normalize(m).withColumn("value", F.round("value", 6))


@query(f"""
WITH a AS (SELECT p_brand AS feature, nation AS sample, sum(q) AS v FROM {_SALES} GROUP BY ALL HAVING sum(q) > 0),
m AS (SELECT DISTINCT p_type AS module, p_brand AS feature FROM part), s AS (SELECT module, count(*) AS n FROM m GROUP BY 1)
SELECT module, sample, round(count(*) / max(n), 6) AS completeness, round(sum(v) / count(*), 4) AS score FROM m JOIN a USING (feature) JOIN s USING (module) GROUP BY ALL HAVING count(*) / max(n) >= 0.5""")
def a13_modules(spark, d):
    a = sales(spark, d).groupBy(F.col("p_brand").alias("feature"), F.col("nation").alias("sample")).agg(F.sum("q").alias("value"))
    m = table(spark, d, "part").select(F.col("p_type").alias("module"), F.col("p_brand").alias("feature")).distinct()
    return matrix.modules(a, m).select("module", "sample", F.round("completeness", 6).alias("completeness"), F.round("score", 4).alias("score"))


@query("""
SELECT e.event_type, e.user_id, round(e.n / t.n, 6) AS share FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL) e
JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) >= 20) t USING (user_id)""")
def a14_relative_to_totals(spark, d):
    e = table(spark, d, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    t = F.sum("n").over(W.partitionBy("user_id"))
    return e.withColumn("t", t).where("t >= 20").select("event_type", "user_id", F.round(F.col("n") / F.col("t"), 6).alias("share"))


@query(f"""
SELECT p_brand, nation, round(sum(q) / max(n), 4) AS value FROM {_SALES} JOIN (SELECT p_brand AS b, count(*) AS n FROM part GROUP BY 1 HAVING count(*) >= 10) s ON s.b = p_brand GROUP BY ALL""")
def a15_member_profiles(spark, d):
    members = table(spark, d, "part").select("p_brand", F.col("p_partkey").alias("feature"))
    return matrix.profile(sales(spark, d), "p_brand", "nation", "q", members, least=10).withColumn("value", F.round("value", 4))


@query(f"SELECT nation, round(avg(s), 4) AS value FROM (SELECT p_type, nation, sum(q) AS s FROM {_SALES} GROUP BY ALL HAVING sum(q) > 0) GROUP BY nation")
def a16_background(spark, d):
    return matrix.background(sales(spark, d), "p_type", "nation", "q").withColumn("value", F.round("value", 4))


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_partkey) >= 10")
def a18_least_members(spark, d):
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("parts")).where("parts >= 10")


_NATIONS = range(25)


@query(f"""
SELECT p_brand, {", ".join(f"coalesce(sum(q) FILTER (nation = {i}), 0) AS s{i}" for i in _NATIONS)}, coalesce(sum(q), 0) AS total FROM {_SALES} GROUP BY ALL""")
def k03_matrix_every_nation(spark, d):
    m = sales(spark, d).groupBy("p_brand", F.concat(F.lit("s"), F.col("nation")).alias("sample")).agg(F.sum("q").alias("q"))
    return matrix.wide(m, "p_brand", "sample", "q", [f"s{i}" for i in _NATIONS])


@query(f"SELECT p_brand, 's' || nation AS sample, sum(q) AS value FROM {_SALES} GROUP BY ALL HAVING sum(q) > 0")
def s08_scan_every_nation(spark, d):
    return matrix.long(k03_matrix_every_nation(spark, d).drop("total"), "p_brand").where("value > 0")


@query("""
WITH p AS (SELECT DISTINCT l_partkey % 40 AS f, l_suppkey AS s FROM lineitem), n AS (SELECT f, count(*) AS n FROM p GROUP BY 1),
b AS (SELECT x.f AS a, y.f AS b, count(*) AS both_n FROM p x JOIN p y ON x.s = y.s AND x.f < y.f GROUP BY ALL)
SELECT b.a, b.b, round((i.n + j.n - 2 * both_n) / (i.n + j.n - both_n), 6) AS ratio FROM b JOIN n i ON b.a = i.f JOIN n j ON b.b = j.f""")
def m08_anti_occurrence(spark, d):
    x = table(spark, d, "lineitem").select((F.col("l_partkey") % 40).alias("f"), "l_suppkey").distinct()
    return matrix.anti_occurrence(x, "f", "l_suppkey", F.lit(True)).withColumn("ratio", F.round("ratio", 6))


@query("""
SELECT label, i, round(avg(x), 5) AS value FROM (SELECT label, unnest(range(0, 64)) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY ALL""")
def m01_mean_vectors(spark, d):
    e = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    return e.groupBy("label", F.col("i").cast("long").alias("i")).agg(F.round(F.avg(F.col("x").cast("double")), 5).alias("value"))


@query("SELECT o_orderpriority, median(o_totalprice) AS median, CAST(count(*) FILTER (o_totalprice > 200000) AS BIGINT) AS over_n FROM orders GROUP BY 1")
def m03_medians(spark, d):
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(F.median("o_totalprice").alias("median"), F.count_if(F.col("o_totalprice") > 200000).alias("over_n"))


@query("""
SELECT user_id, v[least(CAST(floor(len(v) * 0.1) AS INTEGER), len(v) - 1) + 1] AS q10, v[least(CAST(floor(len(v) * 0.9) AS INTEGER), len(v) - 1) + 1] AS q90,
  v[CAST(floor((len(v) - 1) * 0.5 + 0.5) AS INTEGER) + 1] AS q50, CAST(len(list_filter(v, lambda x: x > 50)) AS INTEGER) AS high
FROM (SELECT user_id, list(value ORDER BY value) AS v FROM events GROUP BY 1)""")
def m04_index_quantiles(spark, d):
    v = table(spark, d, "events").groupBy("user_id").agg(F.collect_list("value").alias("v"))
    return v.select("user_id", stats.index_quantile(F.col("v"), 0.1).alias("q10"), stats.index_quantile(F.col("v"), 0.9).alias("q90"), stats.index_quantile_rounded(F.col("v"), 0.5).alias("q50"), F.size(F.filter("v", lambda x: x > 50)).alias("high"))


@query("SELECT l_returnflag, round(coalesce(corr(l_quantity, l_extendedprice), 0), 4) AS r FROM lineitem GROUP BY 1")
def m06_pearson(spark, d):
    return stats.pearson(table(spark, d, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")


@query("""
WITH r AS (SELECT event_type, rank() OVER (PARTITION BY event_type ORDER BY value) + (count(*) OVER (PARTITION BY event_type, value) - 1) / 2.0 AS a,
  rank() OVER (PARTITION BY event_type ORDER BY user_id) + (count(*) OVER (PARTITION BY event_type, user_id) - 1) / 2.0 AS b FROM events)
SELECT event_type, round(1.0 - 6.0 * sum((a - b) * (a - b)) / (count(*) * (count(*)::DOUBLE * count(*) - 1)), 4) AS rho FROM r GROUP BY 1""")
def m07_spearman(spark, d):
    return stats.spearman(table(spark, d, "events"), ["event_type"], "value", "user_id")


@query("""
WITH s AS (SELECT source, n_chars AS len, sum(n_chars) OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING) AS run,
  row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS k, sum(n_chars) OVER (PARTITION BY source) AS total FROM documents)
SELECT source, arg_min(len, k) AS n, min(k) AS l FROM s WHERE run > total // 2 GROUP BY 1""")
def a22_n50(spark, d):
    return assembly.n_descending(table(spark, d, "documents"), "source", "n_chars")


@query("""
SELECT source, count(*) AS sequences, CAST(sum(n_chars) AS BIGINT) AS total, max(n_chars) AS longest, min(n_chars) AS shortest, round(avg(n_chars), 4) AS mean,
  count(*) FILTER (n_chars > 1000) AS over_1k, count(*) FILTER (n_chars > 10000) AS over_10k, list_sort(list(n_chars))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS median FROM documents GROUP BY 1""")
def a22_length_statistics(spark, d):
    return assembly.length_statistics(table(spark, d, "documents"), "source", "n_chars")


@query("""
WITH s AS (SELECT source, n_chars AS len, sum(n_chars) OVER (PARTITION BY source ORDER BY n_chars, doc_id ROWS UNBOUNDED PRECEDING) AS run, sum(n_chars) OVER (PARTITION BY source) AS total FROM documents)
SELECT source, min(len) FILTER (run >= floor(0.2 * total)) AS n20, min(len) FILTER (run >= floor(0.5 * total)) AS n50, min(len) FILTER (run >= floor(0.8 * total)) AS n80 FROM s GROUP BY 1""")
def a23_bin_n20_n50_n80(spark, d):
    docs = table(spark, d, "documents")
    each = [assembly.n_ascending(docs, "source", "n_chars", q / 100).withColumnRenamed("n", f"n{q}") for q in (20, 50, 80)]
    return each[0].join(each[1], "source").join(each[2], "source")


@query("""
WITH t AS (SELECT source, CASE WHEN count(*) FILTER (n_chars > 10000) > 2 THEN 10000 WHEN count(*) FILTER (n_chars > 5000) > 2 THEN 5000 WHEN count(*) FILTER (n_chars > 2000) > 2 THEN 2000
  WHEN count(*) FILTER (n_chars > 1000) > 2 THEN 1000 END AS tier FROM documents GROUP BY 1)
SELECT source, doc_id, n_chars, tier, place FROM (SELECT d.source, doc_id, n_chars, tier, CAST(row_number() OVER (PARTITION BY d.source ORDER BY n_chars DESC, doc_id) AS INTEGER) AS place
FROM documents d JOIN t ON d.source = t.source AND n_chars > tier) WHERE place <= 5""")
def w17_length_tiers(spark, d):
    return assembly.length_tier(table(spark, d, "documents").select("doc_id", "source", "n_chars"), "source", "n_chars")


@query("""
WITH a AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS f FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM a)
SELECT user_id, CAST(run AS BIGINT) AS run, event_type, min(event_id) AS start, max(event_id) AS "end", count(*) AS n FROM b GROUP BY ALL""")
def w02_runs(spark, d):
    return intervals.runs(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type", F.col("event_id"), F.col("event_id"))


@query("SELECT user_id, event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 4 FOLLOWING), 6) AS mean FROM events")
def w01_rolling_mean(spark, d):
    return intervals.rolling_mean(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value", 6, 4, digits=6).select("user_id", "event_id", "mean")


_GENES = "(SELECT o_orderkey AS gene, o_custkey % 150 AS user_id, (o_orderkey * 7) % 9000 AS s, (o_orderkey * 7) % 9000 + o_orderkey % 400 AS e FROM orders)"


@query(f"SELECT gene, user_id, event_id FROM {_GENES} g JOIN events USING (user_id) WHERE event_id BETWEEN s AND e")
def j09_range_join(spark, d):
    o = table(spark, d, "orders")
    genes = o.select(F.col("o_orderkey").alias("gene"), (F.col("o_custkey") % 150).alias("user_id"), ((F.col("o_orderkey") * 7) % 9000).alias("s")).withColumn("e", F.col("s") + F.col("gene") % 400)
    return intervals.range_join(table(spark, d, "events").select("user_id", "event_id"), genes, ["user_id"], "event_id", "s", "e", 400).select("gene", "user_id", "event_id")


@query(f"SELECT user_id, gene, round(sum(value) / (max(e) - max(s) + 1), 11) AS value FROM {_GENES} g JOIN events USING (user_id) WHERE event_id BETWEEN s AND e GROUP BY ALL")
def j10_mean_depth(spark, d):
    o = table(spark, d, "orders")
    genes = o.select(F.col("o_orderkey").alias("gene"), (F.col("o_custkey") % 150).alias("user_id"), ((F.col("o_orderkey") * 7) % 9000).alias("start")).withColumn("end", F.col("start") + F.col("gene") % 400)
    depth = table(spark, d, "events").select("user_id", F.col("event_id").alias("pos"), F.col("value").alias("depth"))
    return intervals.mean_depth(depth, genes, ["user_id"], "gene", 400).withColumn("value", F.round("value", 11))


_KINDS = ("click", "error", "purchase", "signup", "view")


@query(f"""
SELECT user_id, event_id // 1000 AS "window", {", ".join(f"round(coalesce(avg(value) FILTER (event_type = '{k}'), 0), 6) AS {k}" for k in _KINDS)} FROM events GROUP BY ALL""")
def a31_window_coverage(spark, d):
    w = intervals.windows(table(spark, d, "events"), ["user_id"], "event_id", "value", 1000, "event_type", list(_KINDS))
    return w.select("user_id", "window", *[F.round(k, 6).alias(k) for k in _KINDS])


@query("""
WITH r AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity, sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice ROWS UNBOUNDED PRECEDING) - l_quantity AS b,
  sum(l_quantity) OVER (PARTITION BY l_suppkey) AS t FROM lineitem)
SELECT l_suppkey, CAST(least(floor(b * 8 / t), 7) AS INTEGER) AS region, count(*) AS n, sum(l_quantity) AS weight FROM r GROUP BY ALL""")
def m20_weighted_regions(spark, d):
    x = intervals.weighted_regions(table(spark, d, "lineitem"), ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], "l_quantity", 8)
    return x.groupBy("l_suppkey", "region").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("weight"))


@query("SELECT CASE WHEN n_chars < 500 THEN '0' WHEN n_chars < 1000 THEN '500' WHEN n_chars < 5000 THEN '1000' ELSE '5000' END AS bin, count(*) AS n FROM documents GROUP BY 1")
def a35_open_histogram(spark, d):
    b = F.when(F.col("n_chars") < 500, "0").when(F.col("n_chars") < 1000, "500").when(F.col("n_chars") < 5000, "1000").otherwise("5000")
    return table(spark, d, "documents").groupBy(b.alias("bin")).agg(F.count("*").alias("n"))


@query(f"SELECT p_brand, nation, sum(q) AS value FROM {_SALES} WHERE p_brand IN (SELECT p_brand FROM part WHERE p_size >= 49) GROUP BY ALL")
def j11_row_subset(spark, d):
    keys = table(spark, d, "part").where("p_size >= 49")
    return matrix.rows_of(sales(spark, d).groupBy("p_brand", "nation").agg(F.sum("q").alias("value")), keys, "p_brand")


@query(f"SELECT nation, p_type AS top, v AS value FROM (SELECT nation, p_type, sum(q) AS v, row_number() OVER (PARTITION BY nation ORDER BY sum(q) DESC, p_type) AS k FROM {_SALES} GROUP BY nation, p_type) WHERE k <= 3")
def l05_top_reports(spark, d):
    s = sales(spark, d).groupBy("nation", "p_type").agg(F.sum("q").alias("value"))
    return s.withColumn("k", F.row_number().over(W.partitionBy("nation").orderBy(F.desc("value"), "p_type"))).where("k <= 3").select("nation", F.col("p_type").alias("top"), "value")
