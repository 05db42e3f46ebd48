"""URL filters: prefix rules, then exact membership of blocked domains by a cascade of Bloom filters.

A Bloom filter cascade alternates levels: level 1 encodes the listed keys, level 2 the unlisted keys of the
universe that level 1 lets through, level 3 the listed keys that level 2 lets through, and so on until nothing
slips. For every key of the universe the answer is exact, and a probe is a few bit tests on literals: no join.

The universe is complete: every domain suffix of every host of the table. Levels are built with DataFrame
aggregates (one row for each 64-bit word) and lie in tables of one row that plans read as scalar subqueries. Their size
follows the list of blocked domains, not the pages: about 1.5 * log2(universe / listed) + 6 bits for each listed domain that occurs.

Defined cases: a null url, or one without ``://``, has an empty host and path and is allowed; rows repeat as in the
input; an empty table gives no rows; an empty list allows all; null entries of the list are skipped; columns named like host, path, rule
or verdict, in whatever case, are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Bits, Plain, ascii_lower, bit_filter, checkpointed, drop, materialize


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parse_rule(text: str, verdict: str) -> Rule:
    """``example.net/de/8``: the host, and the path from the first slash on."""
    host, slash, path = text.partition("/")
    return Rule(host, slash + path, verdict)


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_suffixes(host: Column) -> Column:
    """``a.b.c``: a.b.c, b.c and c; an empty host has none."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, i, n - i + 1), "."))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(each)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Rule string and verdict of the longest rule that fits; nulls without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, verdict = F.when(fits, r.text).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def cascade_holds(levels: list[Bits], key: Column, words: list[Column] | None = None) -> Column:
    """words: columns that already hold the levels' arrays, for use inside of higher-order functions."""
    held = F.lit(False)
    for i in reversed(range(len(levels))):
        held = levels[i].holds(key, None if words is None else words[i]) & ~held
    return held


def build_level(keys: DataFrame, seed: int, rate: float) -> Bits:
    """A Bloom filter of the column ``key`` with about this rate of false positives."""
    n = keys.count()
    bits = max(64, 64 * math.ceil(n * -math.log(rate) / math.log(2) ** 2 / 64))
    hashes = max(1, round(bits / max(n, 1) * math.log(2))) if n else 1
    return bit_filter(keys, seed, bits, min(hashes, 16))


def build_cascade(universe: DataFrame, listed: DataFrame, first_rate: float | None = None, next_rate: float = 0.5, max_levels: int = 64) -> list[Bits]:
    """Levels that answer exactly for every ``key`` of universe.

    Only the build joins: keys that slipped a level are told apart from listed ones by a semi- or anti-join on what
    is left, which shrinks by the rate from level to level. first_rate: by default the share of listed keys in the universe, so
    that level 2 gets about as many keys as level 1 and all levels' size follows the list, not the universe.
    """
    here = checkpointed(universe.join(listed, "key", "left_semi"))
    if first_rate is None:
        first_rate = min(0.5, max(here.count(), 1) / max(universe.count(), 2))
    levels: list[Bits] = []
    encoded, other = here, None
    for seed in range(1, max_levels + 1):
        level = build_level(encoded, seed, first_rate if seed == 1 else next_rate)
        levels.append(level)
        if other is None:  # unlisted keys that pass level 1
            slipped = universe.where(level.holds(F.col("key"))).join(listed, "key", "left_anti")
        else:
            slipped = other.where(level.holds(F.col("key")))
        slipped = checkpointed(slipped)
        if slipped.isEmpty():
            return levels
        encoded, other = slipped, encoded
    raise RuntimeError("the cascade did not end")


def filter_urls(pages: DataFrame, blocked: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """pages with host, path, rule and verdict; ``blocked`` has one column, domains that are blocked with their subdomains."""
    p = Plain(pages)
    at = F.col(p[url])
    listed = blocked.select(ascii_lower(F.col(blocked.columns[0])).alias("key")).where("key is not null and key != ''").distinct()
    hosts = p.df.select(url_host(at).alias("host")).distinct()
    universe = materialize(hosts.select(F.explode(domain_suffixes(F.col("host"))).alias("key")).distinct())
    levels = build_cascade(universe, listed)
    drop(universe)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = p.df.withColumns({"host": url_host(at), "path": url_path(at)}).withColumns({"rule": rule, "ruled": verdict})
    base = base.withColumns({f"words{i}": level.table.scalar() for i, level in enumerate(levels)})
    # Each array is named once, so that plans keep it as a subquery's value and never copy it into rows.
    words = F.array(F.struct(*[f"words{i}" for i in range(len(levels))]))
    bad = F.exists(words, lambda w: F.exists(domain_suffixes(F.col("host")), lambda k: cascade_holds(levels, k, [w[f"words{i}"] for i in range(len(levels))])))
    return p.back(base.withColumn("verdict", F.coalesce("ruled", F.when(bad, "block").otherwise("allow"))), "host", "path", "rule", "verdict")
