"""A corpus pipeline of five stages; each is written as Parquet and read again as the next one's documents.

Defined cases, for every stage: the documents may have other columns, whatever their names, which pass through; an empty table gives no rows; null and
empty texts are documents like others (no lines, no words, no tokens), and of the near-duplicate stage's one group; rows without an id take part
as their operator says; repeated rows are one document for line dedup, one row after near-dedup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.common import Plain, table, written
from granary.llm.near_copies import first_copies
from granary.llm.op10_lines import dedup_lines
from granary.llm.op3_bpe import encode_digests
from granary.llm.op7_toxicity import score_table
from granary.llm.op9_mix import mix_documents
from granary.llm.queries import default_pattern, default_vocabulary

#: Near-duplicates share NEAR_SHARE[0] / NEAR_SHARE[1] of their shingles of NEAR_WORDS words. NEAR_BITS, the limit of an earlier SimHash rule, links nothing any more: fingerprints give candidates, shares decide.
NEAR_WORDS, NEAR_SHARE, NEAR_BITS = 5, (4, 5), 8


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; labels come from the tables' folder. A row without an id is scored and never learned from."""
    p = Plain(docs)
    scored = score_table(p.df, table(spark, sf_dir, "labels"), p["doc_id"], p["text"], lang=p.find("lang") or "lang", label_key="doc_id")
    return p.back(scored.where("not rejected"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats go; every document stays, n_chars follows its text. Rows without an id keep all lines."""
    p = Plain(docs)
    out, size = dedup_lines(p.df, p["doc_id"], p["text"]), p.find("n_chars")
    return p.back(out.withColumn(size, F.length(p["text"]).cast("long")) if size else out)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (SimHash candidates, then a prefix join's; exact shares) one row stays, that with the smallest id; rows without an id come last."""
    return first_copies(docs, "doc_id", "text", NEAR_WORDS, *NEAR_SHARE)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; repeated ones are repeated rows. Null sources are one source."""
    p = Plain(docs)
    mixed = mix_documents(p.df, p["doc_id"], p["source"], p["text"])
    return p.back(mixed.withColumn("one", F.explode(F.array_repeat(F.lit(1), F.col("copies")))))


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return encode_digests(docs, default_vocabulary(), default_pattern())


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash_near_dedup", simhash_near_dedup), ("source_mix", source_mix), ("bpe_round_trip", bpe_round_trip)]

#: The classifier and the tokenizer have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
