"""Quality rules as a short-circuit cascade.

Each rule's cost (seconds of its expression over a bounded sample) and selectivity (share that it rejects of what the rules before it
leave there) are estimated; rules run in the order of rejection per cost, each only on documents that none before it rejected. A
document is kept if no rule rejects it, so the order changes the work and never the verdict.

Everything is Spark SQL over one document at a time: no shuffle, no Python. Repeated three-word windows come from
sorting one array of longs, window hash in the upper and position in the lower bits; where two different windows share a hash, that
document's windows are compared as words.

Defined cases: a null or empty text has zero counts and fails the base rule (under 50 words); repeated rows repeat; an empty table
gives no rows; names of extra columns do not matter, only id and text are read.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Plain, words_of

#: Fixed values of the base counts.
SYMBOLS = "#*$%&|<>"
#: The sample that orders the rules, and how often it is evaluated for a time.
SAMPLE_ROWS, SAMPLE_CHARS, REPEATS, RUNS = 400, 50_000, 10, 3


@dataclass(frozen=True)
class Rule:
    """Rejects where sql is true; it may use the base columns, ``_text`` and ``_lines``."""

    name: str
    sql: str


RULES = (
    Rule("symbols", "10 * n_symbols > word_chars"),
    Rule("duplicate_lines", "2 * n_dup_lines > size(_lines)"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("capitals", "5 * regexp_count(_text, '[A-Z]') > 2 * word_chars"),
    Rule("exclamations", "2 * (length(_text) - length(replace(_text, '!', ''))) > n_words"),
    Rule("ellipses", "size(filter(_lines, x -> rtrim(x) rlike '(\\\\.\\\\.\\\\.|\\u2026)$')) * 10 > 3 * size(_lines)"),
    Rule("bullets", "size(filter(_lines, x -> ltrim(x) rlike '^[-*\\u2022]')) * 10 > 9 * size(_lines)"),
)

# Array expressions: a sorted long holds a window's hash (33 bits) and position (31 bits).
_WINDOWS = "transform(sequence(0, size(_words) - 3), i -> (xxhash64(_words[i], _words[i + 1], _words[i + 2]) & -2147483648L) | i)"
_PAIRS = "array_remove(zip_with(_enc, slice(_enc, 2, greatest(size(_enc), 1)), (a, b) -> if(shiftright(a ^ b, 31) = 0, shiftleft(a & 2147483647L, 31) | (b & 2147483647L), -1L)), -1L)"
_LEFT, _RIGHT = "transform(_pairs, x -> shiftright(x, 31))", "transform(_pairs, x -> x & 2147483647L)"
_DIFFER = " or ".join(f"_words[cast(a as int) + {k}] != _words[cast(b as int) + {k}]" for k in range(3))
_COLLISION = f"exists(zip_with({_LEFT}, {_RIGHT}, (a, b) -> {_DIFFER}), x -> x)"
_EXACT = f"array_sort(transform(array_union({_LEFT}, {_RIGHT}), p -> struct(_words[cast(p as int)] as w0, _words[cast(p as int) + 1] as w1, _words[cast(p as int) + 2] as w2, p)))"
_NEXT = " and ".join(f"get(_ex, i {{0}} 1).w{k} = x.w{k}" for k in range(3))
_EXACT_AT = f"transform(filter(_ex, (x, i) -> (i > 0 and {_NEXT.format('-')}) or (i + 1 < size(_ex) and {_NEXT.format('+')})), x -> x.p)"
_COVER = "aggregate(sort_array(_at), named_struct('c', 0L, 'e', 0L), (a, p) -> named_struct('c', a.c + p + 3 - greatest(p, a.e), 'e', p + 3), a -> a.c)"


def base_counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base columns, and ``_text`` and ``_lines`` for the rules."""
    p = Plain(docs)
    t = p.df.select(F.col(p[key]).alias("doc_id"), F.coalesce(F.col(p[text]), F.lit("")).alias("_text"))
    t = t.withColumn("_words", words_of(F.col("_text")))
    t = t.withColumn("n_words", F.size("_words").cast("long"))
    t = t.withColumn("_enc", F.expr(f"case when n_words >= 3 then sort_array({_WINDOWS}) else cast(array() as array<bigint>) end"))
    t = t.withColumn("_pairs", F.expr(_PAIRS))
    t = t.withColumn("_ex", F.expr(f"case when {_COLLISION} then {_EXACT} end"))
    t = t.withColumn("_at", F.expr(f"case when _ex is null then array_union({_LEFT}, {_RIGHT}) else {_EXACT_AT} end"))
    t = t.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    t = t.select(
        "doc_id", "n_words", "_text", "_lines",
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(_COVER).alias("n_repeat_words"),
    )
    return t.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))


def rejections(sample: DataFrame, rules: tuple[Rule, ...]) -> tuple[np.ndarray, list[float]]:
    """Which rows of a small cached sample each rule rejects, and the seconds that a rule's expression takes on all of them.

    Every row is evaluated ``REPEATS`` times and the time of the same job without a rule is taken off, so that what is compared is the
    expressions and not the jobs around them; of several runs the fastest counts.
    """
    hit = sample.select(*[F.coalesce(F.expr(r.sql), F.lit(False)).alias(f"r{i}") for i, r in enumerate(rules)]).toPandas().to_numpy(bool).reshape(-1, len(rules))
    many = sample.withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def seconds(sql: str) -> float:
        job, took = many.agg(F.sum(F.expr(sql).cast("int"))), []
        for _ in range(RUNS):
            began = time.perf_counter()
            job.collect()
            took.append(time.perf_counter() - began)
        return min(took)

    nothing = seconds("turn > 0")
    return hit, [max(seconds(f"turn > 0 and ({r.sql})") - nothing, 1e-4) for r in rules]


def best_order(hit: np.ndarray, cost: list[float]) -> list[int]:
    """Greedy: next comes the rule with the highest rejection per cost among the rows that the rules before it leave."""
    left, out = np.ones(len(hit), bool), []
    while len(out) < len(cost):
        share = hit[left].mean(axis=0) if left.any() else np.zeros(len(cost))
        i = max((i for i in range(len(cost)) if i not in out), key=lambda i: ((share[i] + 1e-6) / cost[i], -i))
        out.append(i)
        left &= ~hit[:, i]
    return out


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """Rules in the order of the cascade, with their share rejected and seconds, from at most ``rows`` documents.

    The sample are the first documents found whose hash of id and text falls into a part of all hashes that is wide enough for 64 times
    ``rows``; texts over ``SAMPLE_CHARS`` are left out of it. Spark reads partitions one after another until it has them.
    """
    p = Plain(docs)
    slim = p.df.select(F.col(p[key]).alias("id"), F.col(p[text]).alias("text"))
    part = max(1, slim.count() // (64 * rows))
    picked = slim.where((F.pmod(F.xxhash64("id", "text"), F.lit(part)) == 0) & (F.length(F.coalesce("text", F.lit(""))) <= SAMPLE_CHARS))
    few = docs.sparkSession.createDataFrame(picked.limit(rows).toArrow())
    sample = base_counts(few, "id", "text").cache()
    try:
        hit, cost = rejections(sample.where("not base_failed"), rules)
    finally:
        sample.unpersist()
    return [(rules[i], float(hit[:, i].mean()) if len(hit) else 0.0, cost[i]) for i in best_order(hit, cost)]


def apply_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text", ordered: list[Rule] | None = None) -> DataFrame:
    """doc_id, the base columns, base_failed and kept."""
    ordered = ordered if ordered is not None else [r for r, _, _ in order_rules(docs, rules, key, text)]
    kept = F.lit(True)
    for r in reversed(ordered):
        kept = F.when(F.expr(r.sql), F.lit(False)).otherwise(kept)
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(kept)
    out = base_counts(docs, key, text).withColumn("kept", kept)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
