"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .op10_lines import dedup_report
from .op1_url_filter import filter_urls, parse_rule
from .op2_simhash import near_duplicates
from .op3_bpe import Vocabulary, encode_digests
from .op4_shards import shard_table
from .op5_ann import nearest
from .op6_substrings import substring_dedup
from .op7_toxicity import score_table
from .op8_quality import apply_quality
from .op9_mix import mix_documents

#: Rules of op1 (fixed by its contract) and its blocked domains.
URL_RULES = [parse_rule("com/en/", "block"), parse_rule("example.com/en/7", "allow"), parse_rule("net/de/", "allow"), parse_rule("example.net/de/8", "block"), parse_rule("org/es/", "block")]
BLOCKED_DOMAINS = [f"{name}.example.{top}" for name in ("ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org")]


@cache
def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocked = spark.createDataFrame([(d,) for d in BLOCKED_DOMAINS], "domain string")
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), blocked, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), default_vocabulary(), default_pattern())


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_table(table(spark, sf_dir, "documents"), [1.0] * 16)


def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


def op7_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_table(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "rejected")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_quality(table(spark, sf_dir, "documents"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_documents(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_simhash_groups": op2_simhash_groups,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_sharding": op4_sharding,
    "op5_nearest_vectors": op5_nearest_vectors,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_toxicity_scores": op7_toxicity_scores,
    "op8_quality_rules": op8_quality_rules,
    "op9_source_mix": op9_source_mix,
    "op10_line_dedup": op10_line_dedup,
}

_DOMAINS = ", ".join(f"'{d}'" for d in BLOCKED_DOMAINS)

ORACLE_SQL: dict[str, str] = {
    "op1_url_filters": f"""
        WITH p AS (
          SELECT page_id,
            translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
          FROM pages),
        r AS (SELECT * FROM (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'),
              ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')) t(rh, rp, v)),
        m AS (SELECT p.page_id, p.host, p.path, (
                SELECT rh || rp || '|' || v FROM r
                WHERE (p.host = rh OR ends_with(p.host, '.' || rh)) AND starts_with(p.path, rp)
                ORDER BY length(rh || rp) DESC LIMIT 1) AS hit FROM p)
        SELECT page_id, host, path, CASE WHEN hit IS NOT NULL THEN split_part(hit, '|', 1) END AS rule,
          CASE WHEN hit IS NOT NULL THEN split_part(hit, '|', 2)
               WHEN len(list_filter([{_DOMAINS}], lambda x: host = x OR ends_with(host, '.' || x))) > 0 THEN 'block'
               ELSE 'allow' END AS verdict
        FROM m""",
}
