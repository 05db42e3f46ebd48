"""Sequence functions, consensus and alignment columns over proxies.

A sequence is a document's text with letters mapped onto ACGT; an alignment are the whole sequences of one source and one length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequence as seq
from ..operators import consensus, hits
from ..plans.registry import query, table

# Letters to bases, e to A and so on.
LETTERS, MAPPED = "etaoinshrdlu", "ACGTACGTACGT"
_SEQ = f"(SELECT doc_id, source, regexp_replace(translate(lower(text), '{LETTERS}', '{MAPPED}'), '[^ACGT]', '', 'g') AS s FROM documents) q"


def sequences(spark: SparkSession, d: str) -> DataFrame:
    t = F.regexp_replace(F.translate(F.lower("text"), LETTERS, MAPPED), "[^ACGT]", "")
    return table(spark, d, "documents").select("doc_id", "source", t.alias("s"))


@query(f"SELECT doc_id, translate(reverse(s), 'ACGT', 'TGCA') AS rc FROM {_SEQ}")
def f01_reverse_complement(spark, d):
    return sequences(spark, d).select("doc_id", seq.reverse_complement(F.col("s")).alias("rc"))


@query("""
SELECT doc_id, translate(reverse(regexp_replace(translate(lower(text), 'etaoinshrdlu', 'ACGTRYKMBVHD'), '[^A-Z]', '', 'g')), 'ACGTRYKMBVHD', 'TGCAYRMKVBDH') AS rc FROM documents""")
def f02_iupac_reverse_complement(spark, d):
    s = F.regexp_replace(F.translate(F.lower("text"), "etaoinshrdlu", "ACGTRYKMBVHD"), "[^A-Z]", "")
    return table(spark, d, "documents").select("doc_id", seq.reverse_complement(s, iupac=True).alias("rc"))


_CODON_CASE = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in seq.codon_table().items()) + "}"


@query(f"SELECT doc_id, CASE WHEN length(s) < 3 THEN '' ELSE array_to_string([({_CODON_CASE})[substr(s, CAST(i * 3 - 2 AS BIGINT), 3)] FOR i IN range(1, length(s) // 3 + 1)], '') END AS protein FROM {_SEQ}")
def f03_translation(spark, d):
    return sequences(spark, d).select("doc_id", seq.translate_codons(F.col("s")).alias("protein"))


@query(f"""
SELECT doc_id, CASE WHEN length(s) = 0 THEN -1.0::DOUBLE ELSE round(100.0::DOUBLE * length(regexp_replace(s, '[AT]', '', 'g')) / length(s), 3) END AS gc FROM {_SEQ}""")
def f04_gc(spark, d):
    return sequences(spark, d).select("doc_id", seq.gc_percent(F.col("s")).alias("gc"))


@query(f"""
WITH t AS (SELECT doc_id, s, array_to_string([substr(s, CAST(i * 3 AS BIGINT), 1) FOR i IN range(1, length(s) // 3 + 1)], '') AS x FROM {_SEQ})
SELECT doc_id, CASE WHEN length(s) % 3 = 0 THEN CASE WHEN length(x) = 0 THEN -1.0::DOUBLE ELSE round(100.0::DOUBLE * length(regexp_replace(x, '[AT]', '', 'g')) / length(x), 3) END END AS gc3 FROM t""")
def f05_gc3(spark, d):
    return sequences(spark, d).select("doc_id", seq.gc3_percent(F.col("s")).alias("gc3"))


@query(f"""
WITH k AS (SELECT source, unnest([substr(s, CAST(i AS BIGINT), 3) FOR i IN range(1, greatest(length(s) - 1, 1))]) AS m FROM {_SEQ} WHERE length(s) >= 3),
n AS (SELECT source, m, count(*) AS c FROM k GROUP BY ALL), b AS (SELECT source, m, c FROM n UNION ALL SELECT source, translate(reverse(m), 'ACGT', 'TGCA'), c FROM n)
SELECT source, m AS kmer, CAST(sum(c) AS BIGINT) AS n, round(100.0::DOUBLE * sum(c) / sum(sum(c)) OVER (PARTITION BY source), 5) AS percent FROM b GROUP BY source, m""")
def f06_kmer_frequencies(spark, d):
    from pyspark.sql import Window as W

    n = seq.kmer_counts(sequences(spark, d), "source", "s", 3).where("kmer rlike '^[ACGT]+$'")
    both = n.union(n.select("source", seq.reverse_complement(F.col("kmer")), "n")).groupBy("source", "kmer").agg(F.sum("n").alias("n"))
    return both.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy("source")), 5))


@query(f"""
WITH q AS (SELECT * FROM {_SEQ} WHERE length(s) >= 200), k AS (SELECT source, unnest([substr(s, CAST(i AS BIGINT), 4) FOR i IN range(1, length(s) - 2)]) AS m FROM q),
n AS (SELECT source, m, count(*) AS c FROM k GROUP BY ALL), b AS (SELECT source, m, c FROM n UNION ALL SELECT source, translate(reverse(m), 'ACGT', 'TGCA'), c FROM n), t AS (SELECT source, m, sum(c) AS n FROM b GROUP BY ALL),
x AS (SELECT unnest(['A', 'C', 'G', 'T']) AS x), every AS (SELECT source, a.x || b.x || c.x || d.x AS m FROM (SELECT DISTINCT source FROM q), x a, x b, x c, x d)
SELECT source, m AS kmer, CAST(coalesce(n, 0) AS BIGINT) AS n FROM every LEFT JOIN t USING (source, m)""")
def f06_kmer_table(spark, d):
    return seq.kmer_table(sequences(spark, d), "source", "s", 4, 200)


@query(f"SELECT doc_id, CAST(i AS INTEGER) AS start, CAST(least(i + 499, length(s)) AS INTEGER) AS \"end\", length(substr(s, i, 500)) AS len FROM (SELECT doc_id, s, unnest(range(1, length(s) + 1, 500)) AS i FROM {_SEQ} WHERE length(s) > 0)")
def f07_chunks(spark, d):
    c = sequences(spark, d).select("doc_id", F.explode(seq.chunks(F.col("s"), 500)).alias("c"))
    return c.select("doc_id", "c.start", "c.end", F.length("c.seq").cast("long").alias("len"))


@query("SELECT doc_id, source || '_' || row_number() OVER (PARTITION BY source ORDER BY doc_id) AS name FROM documents")
def f08_renamed_headers(spark, d):
    from pyspark.sql import Window as W

    n = F.row_number().over(W.partitionBy("source").orderBy("doc_id"))
    return table(spark, d, "documents").select("doc_id", F.concat_ws("_", "source", n).alias("name"))


@query("SELECT p_partkey, regexp_replace(substr(p_name || ':' || p_brand || '(' || p_type || ')', 1, 40), '[\\s:;,()\\[\\]'']', '|', 'g') AS name FROM part")
def f09_newick_safe(spark, d):
    return table(spark, d, "part").select("p_partkey", seq.newick_safe(F.concat("p_name", F.lit(":"), "p_brand", F.lit("("), "p_type", F.lit(")"))).alias("name"))


@query("SELECT c_custkey, c_name ~ '^[+-]?[0-9]+$' AS is_name, right(c_name, 4) ~ '^[+-]?[0-9]+$' AS is_end FROM customer")
def f11_is_integer(spark, d):
    return table(spark, d, "customer").select("c_custkey", seq.is_integer(F.col("c_name")).alias("is_name"), seq.is_integer(F.expr("right(c_name, 4)")).alias("is_end"))


@query("SELECT o_orderkey, floor(o_totalprice * 10 + 0.5) / 10 AS p, floor(-o_totalprice + 0.5) AS m FROM orders")
def f19_round_half_up(spark, d):
    return table(spark, d, "orders").select("o_orderkey", seq.round_half_up(F.col("o_totalprice"), 1).alias("p"), seq.round_half_up(-F.col("o_totalprice"), 0).alias("m"))


@query("SELECT l_orderkey, CAST(sum(l_quantity) AS DOUBLE) AS total FROM lineitem GROUP BY 1")
def f23_sum_of_list(spark, d):
    x = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(F.collect_list("l_quantity"), lambda v: v.cast("string")), ",").alias("s"))
    return x.select("l_orderkey", seq.sum_list(F.col("s")).alias("total"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def f26_json(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CAST(len(regexp_extract_all(html, '<p[ >]')) AS INTEGER) AS paragraphs FROM pages")
def s28_regex_statistics(spark, d):
    p = table(spark, d, "pages")
    return p.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit("<p[ >]")).alias("paragraphs"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN n < 1 THEN 'N' WHEN l_quantity > 20 AND n < 30000 THEN upper(b) ELSE lower(b) END AS base
FROM (SELECT *, n_alt + n_ref AS n, CASE WHEN n_alt / greatest(n_alt + n_ref, 1) > 0.501 AND n_alt + n_ref > 1 THEN l_returnflag ELSE l_linestatus END AS b FROM (SELECT *, l_partkey % 7 AS n_alt, l_suppkey % 5 AS n_ref FROM lineitem))""")
def f16_consensus_call(spark, d):
    x = table(spark, d, "lineitem").withColumn("a", F.col("l_partkey") % 7).withColumn("r", F.col("l_suppkey") % 5)
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", consensus.call(F.col("l_linestatus"), F.col("l_returnflag"), F.col("r"), F.col("a"), F.col("l_quantity")).alias("base"))


@query("""
WITH r AS (SELECT l_orderkey AS pos, l_returnflag AS allele, l_extendedprice AS qual, row_number() OVER w AS k, first_value(l_returnflag) OVER w AS f FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_returnflag))
SELECT pos, arg_min(allele, k) AS allele, max(qual) AS qual, CAST(sum(CASE WHEN allele != f THEN 1 ELSE 0 END) AS BIGINT) AS conflicts FROM r GROUP BY 1""")
def w18_position_conflicts(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("pos"), F.col("l_returnflag").alias("allele"), F.col("l_extendedprice").alias("qual"))
    return consensus.resolve_positions(x, ["pos"], "qual", "allele")


@query("SELECT CAST(floor(100.0 * a / (a + r)) AS BIGINT) AS percent, count(*) AS n FROM (SELECT l_partkey % 7 AS a, l_suppkey % 5 AS r FROM lineitem) WHERE a + r > 0 GROUP BY 1")
def a33_frequency_histogram(spark, d):
    x = table(spark, d, "lineitem").select((F.col("l_partkey") % 7).alias("a"), (F.col("l_suppkey") % 5).alias("r"))
    return consensus.frequency_histogram(x, "a", "r")


_MSA = f"(SELECT source || ':' || length(s) AS gene, doc_id AS species, s FROM {_SEQ} WHERE length(s) > 0)"


def aligned(spark, d):
    """msa with the empty sequences."""
    return sequences(spark, d).select(F.concat_ws(":", "source", F.length("s").cast("string")).alias("gene"), F.col("doc_id").alias("species"), "s")


def msa(spark, d):
    return aligned(spark, d).where("length(s) > 0")


_COLUMNS = f"c AS (SELECT gene, species, unnest(range(1, length(s) + 1)) AS pos, s FROM {_MSA}), b AS (SELECT gene, species, pos, substr(s, pos, 1) AS x FROM c), v AS (SELECT gene, pos FROM b GROUP BY ALL HAVING count(DISTINCT x) > 1)"


@query(f"""
WITH {_COLUMNS}, n AS (SELECT gene, count(*) AS n FROM {_MSA} m GROUP BY 1), k AS (SELECT gene, count(*) AS k FROM v GROUP BY 1)
SELECT gene, n, coalesce(k, 0) AS segregating, round(coalesce(k, 0) / list_sum([1.0::DOUBLE / i FOR i IN range(1, greatest(n - 1, 1) + 1)]), 6) AS theta FROM n LEFT JOIN k USING (gene)""")
def a39_watterson(spark, d):
    return consensus.watterson(msa(spark, d), "gene", "species", "s")


@query(f"WITH {_COLUMNS} SELECT gene, species, string_agg(x, '' ORDER BY pos) AS seq FROM b JOIN v USING (gene, pos) GROUP BY ALL")
def f15_variable_columns(spark, d):
    # Empty sequences have no columns; a filter on the length would derive every sequence twice.
    return consensus.variable_columns(aligned(spark, d), "gene", "species", "s").select("gene", "species", "seq")


@query(f"""
SELECT a.gene, a.species AS a, b.species AS b, round(100.0::DOUBLE * len([i FOR i IN range(1, length(a.s) + 1) IF substr(a.s, i, 1) = substr(b.s, i, 1)]) / length(a.s), 6) AS identity FROM {_MSA} a JOIN {_MSA} b ON a.gene = b.gene AND a.species < b.species""")
def f13_pair_identity(spark, d):
    x, y = msa(spark, d).alias("x"), msa(spark, d).alias("y")
    p = x.join(y, (F.col("x.gene") == F.col("y.gene")) & (F.col("x.species") < F.col("y.species")))  # pairs inside a gene are what is asked for
    return p.select(F.col("x.gene").alias("gene"), F.col("x.species").alias("a"), F.col("y.species").alias("b"), F.round(seq.pair_identity(F.col("x.s"), F.col("y.s")), 6).alias("identity"))


@query("""
SELECT l_suppkey AS a, l_partkey % 10 AS b, round(sum((100 - 100 * l_discount) * l_quantity) / sum(l_quantity), 6) AS pid FROM lineitem GROUP BY ALL""")
def a37_merged_identities(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("a"), (F.col("l_partkey") % 10).alias("b"), (100 - 100 * F.col("l_discount")).alias("pid"), "l_quantity")
    return consensus.merge_identities(x, "a", "b", "pid", "l_quantity").withColumn("pid", F.round("pid", 6))


@query("""
SELECT lang, count(*) FILTER (p = '00') AS complete, count(*) FILTER (p = '01') AS open_3, count(*) FILTER (p = '10') AS open_5, count(*) FILTER (p = '11') AS fragment
FROM (SELECT lang, CASE WHEN doc_id % 2 = 0 THEN '0' ELSE '1' END || CASE WHEN doc_id % 3 = 0 THEN '0' ELSE '1' END AS p FROM documents) GROUP BY 1""")
def a24_gene_completeness(spark, d):
    from ..sources.formats import partial_class

    p = F.concat(F.when(F.col("doc_id") % 2 == 0, "0").otherwise("1"), F.when(F.col("doc_id") % 3 == 0, "0").otherwise("1"))
    x = table(spark, d, "documents").select("lang", partial_class(p).alias("kind"))
    return x.groupBy("lang").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in ("complete", "open_3", "open_5", "fragment")])


@query("SELECT doc_id, n_chars, length(regexp_replace(text, '[^aeiouAEIOU]', '', 'g')) AS vowels FROM documents")
def a29_length_table(spark, d):
    return table(spark, d, "documents").select("doc_id", "n_chars", F.length(F.regexp_replace("text", "[^aeiouAEIOU]", "")).cast("long").alias("vowels"))


@query("SELECT source, array_to_string(list_sort(list(DISTINCT lang)), ',') AS langs, arg_max(doc_id, doc_id) AS last_doc FROM documents GROUP BY 1")
def d02_group_objects(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.array_join(F.sort_array(F.collect_set("lang")), ",").alias("langs"), F.max("doc_id").alias("last_doc"))


@query("SELECT user_id, event_type AS last_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def s05_last_duplicate_wins(spark, d):
    return hits.best_hit(table(spark, d, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", F.col("event_type").alias("last_type"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def t01_hourly_windows(spark, d):
    """The batch twin of streaming.windowed_counts."""
    from ..streaming.windows import windowed_counts

    return windowed_counts(table(spark, d, "events"), "1 hour").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))
