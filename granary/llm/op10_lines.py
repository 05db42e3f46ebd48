"""Line dedup by an exact set-similarity join (Jaccard of line tokens, num/den or more), in DataFrame operations only.

A line's tokens are ordered by rarity: frequencies of all words, counted by hash range, give each token a class, and a token is a long with its class
on top and 57 bits of XXH64 below, so sorting the longs sorts by rarity. Lines with equal token sets are one set, placed at their first line.
Sets that can reach the threshold share a token of their prefixes; of those that do, length, positional and parity filters (bits of token
parities: their Hamming distance is at most the symmetric difference) leave few, whose tokens are then compared exactly. 64 bits tell sets of up to
some 100 tokens apart; sets of ``LONG`` tokens and more have WORDS times as many, which fold to 64 where one partner is shorter.

Crowds of near-equal lines: each set is first held against one of a few leaders, the earliest sets (one in each of ``LEADERS`` hash ranges of sets)
with the same smallest or largest token hash of the prefix: the one whose parities leave most room. Sets that a leader proves need no other partner; only the
others probe the full prefix join, for partners of earlier documents alone, and there too the likeliest one goes first, so no match is lost. What still grows with the
square of a crowd are sets just below the threshold: nothing but their tokens tells them apart from matches. A line is removed if an earlier line (by id, then text hash, then place) has an equal set or one
that reaches the threshold, whether or not that earlier line is itself kept.

Sets too small to reach the threshold with a set of another size (at 4/5 those of under four tokens) only need the equal-set path and have no prefix.
The class table and the membership filters are tables of one row that plans read as scalar subqueries, so plans stay small.

Defined cases: null or empty texts have no lines to remove; lines of under ``min_tokens`` distinct words (by default those without a word) are kept and
remove nothing; rows of one id and one text count as one document, rows of one id with different texts as several; rows without an id keep all their
lines and remove none; ids may be of any orderable type; an empty table gives no rows; extra columns pass through, whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, Plain, bit_filter, checkpointed, drop, materialize, one_row, settle, tidy

COUNTER_BITS, LEADERS, PARTS, LONG, WORDS = 18, 32, 4, 64, 4
PLACE = ["doc", "th", "line_no"]
SIGS = [f"sig{k}" for k in range(WORDS)]


def _parts(line: Column) -> Column:
    """The words of a line and empty strings; only lines with a rarer white-space character need the pattern."""
    odd = F.lit(False)
    for c in "\t\x0b\f\r":
        odd = odd | F.contains(line, F.lit(c))
    return F.when(odd, F.split(line, SPACE_CLASS)).otherwise(F.split(line, " "))


def _hashes(line: Column) -> Column:
    """XXH64 of the distinct words of a line."""
    return F.array_remove(F.array_distinct(F.transform(_parts(line), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def rarity_classes(docs: DataFrame, bits: int = COUNTER_BITS) -> DataFrame:
    """One row: for each range of hashes with equal lower ``bits`` the class (0 to 63) of its frequency over all words. 2^bits numbers at most reach the driver."""
    lines = docs.select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line"))
    at = lines.select(F.explode(_parts(F.col("line"))).alias("w")).where("w != ''").select(F.xxhash64("w").bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias("i"))
    level = F.least(F.lit(63), F.floor(F.log2("n") * 2).cast("int"))
    found = at.groupBy("i").agg(F.count("*").alias("n")).select("i", level.alias("c")).toArrow()
    classes = np.zeros(1 << bits, np.int8)
    classes[found["i"].to_numpy()] = found["c"].to_numpy()
    return one_row(docs.sparkSession, "classes", classes)


def _lines(docs: DataFrame) -> DataFrame:
    """doc, th, line_no and line of the lines with a word; docs: doc, th, text."""
    each = docs.where("doc is not null").select("doc", "th", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line"))
    return each.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))


def line_sets(docs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """doc, th, line_no, n, set, SIGS and prefix (32-bit names of the rarest tokens) of each line with a word; docs: doc, th, text.

    Sets of under LONG tokens have all their parities in the first of SIGS and zeros in the others.
    """
    hashed = _lines(docs).select(*PLACE, _hashes(F.col("line")).alias("hashes"), classes.scalar().alias("classes"))
    low = F.lit((1 << COUNTER_BITS) - 1)
    token = F.transform("hashes", lambda h: F.shiftleft(F.get("classes", h.bitwiseAND(low).cast("int")).cast("long"), 57).bitwiseOR(F.shiftrightunsigned(h, 7)))
    t = hashed.select(*PLACE, F.sort_array(token).alias("toks"))
    n, bit = "size(toks)", "shiftleft(1L, cast(x & 63 as int))"
    word = lambda k: f"aggregate(toks, 0L, (a, x) -> if((x & {64 * (WORDS - 1)}) = {64 * k}, a ^ {bit}, a))"
    short = [f"aggregate(toks, 0L, (a, x) -> a ^ {bit})", *["0L"] * (WORDS - 1)]
    parity = [F.expr(f"if({n} < {LONG}, {short[k]}, {word(k)})").alias(c) for k, c in enumerate(SIGS)]
    other = f"{den} * {n} >= {num} * ({n} + 1)"  # the closest set of another size has one token more
    prefix = F.expr(f"transform(slice(toks, 1, if({other}, {n} - (({num} * {n} + {den - 1}) div {den}) + 1, 0)), x -> hash(x))")
    return t.select(*PLACE, F.expr(n).alias("n"), F.xxhash64("toks").alias("set"), *parity, prefix.alias("prefix"))


def _need(num: int, den: int, n: str = "n", o_n: str = "o_n") -> str:
    """The overlap that sets of n and o_n tokens need."""
    return f"(({num} * ({n} + {o_n}) + {num + den - 1}) div {num + den})"


def _slack(num: int, den: int, n: str = "n", o_n: str = "o_n") -> str:
    """What the symmetric difference may be, less what parities say it is at least; below 0: no match."""
    folded = f"bit_count({' ^ '.join(f'{c} ^ o_{c}' for c in SIGS)})"
    apart = f"if(least({n}, {o_n}) < {LONG}, {folded}, {' + '.join(f'bit_count({c} ^ o_{c})' for c in SIGS)})"
    return f"({n} + {o_n} - 2 * {_need(num, den, n, o_n)} - {apart})"


def _near(num: int, den: int, n: str = "n", o_n: str = "o_n") -> str:
    """Length and parity filters on n, o_n, SIGS and those of the other set."""
    return f"{den} * least({n}, {o_n}) >= {num} * greatest({n}, {o_n}) and {_slack(num, den, n, o_n)} >= 0"


def _led(sets: DataFrame, num: int, den: int) -> DataFrame:
    """set and o_set: of each set the leader from an earlier document that passes the filters with most room."""
    keys = F.explode(F.array_distinct(F.array(F.array_min("prefix"), F.array_max("prefix")))).alias("k")
    rows = sets.where("size(prefix) > 0").select("set", F.col("first.doc").alias("doc"), "n", *SIGS, keys)
    leads = rows.groupBy("k", F.pmod("set", F.lit(LEADERS)).alias("part")).agg(F.min(F.struct("doc", "set", "n", *SIGS)).alias("lead"))
    leads = leads.select("k", *[F.col(f"lead.{c}").alias(f"o_{c}") for c in ("doc", "set", "n", *SIGS)])
    found = rows.join(leads, "k").where(f"o_doc < doc and {_near(num, den)}").select("set", "o_set", F.expr(_slack(num, den)).alias("slack"))
    return found.groupBy("set").agg(F.max_by("o_set", F.struct("slack", "o_set")).alias("o_set"))


def _joined(probes: DataFrame, others: DataFrame, num: int, den: int, part: int) -> DataFrame:
    """set, o_set, same and slack: pairs of a probe and a set of an earlier document, or of its own (same), that share a token of one part of all tokens in their prefixes and pass all filters.

    Of two sets the smaller one needs only the prefix for the overlap with a set of its own size, n - ceil(2 * num * n / (num + den)) + 1 tokens, so one side of the
    join is little more than half of the other. Sets are probes or others; others have no partner to find.
    """
    columns = ["set", "n", *SIGS, "prefix"]
    every = probes.select(*columns, "first.doc", F.lit(1).alias("probe")).union(others.select(*columns, "first.doc", F.lit(0).alias("probe")))
    rows = every.select("doc", "set", "n", "probe", *SIGS, F.posexplode("prefix").alias("pos", "token")).where(F.pmod("token", F.lit(PARTS)) == part)
    at = F.expr("shiftleft(cast(n as bigint), 32) | shiftleft(cast(pos as bigint), 1) | probe").alias("at")
    large = rows.select("token", "doc", "set", *SIGS, at)
    few = rows.where(f"pos <= n - ((2 * {num} * n + {num + den - 1}) div {num + den})")
    small = few.select("token", *[F.col(c).alias(f"o_{c}") for c in ("doc", "set", *SIGS)], at.alias("o_at"))
    n, o_n = "cast(shiftright(at, 32) as int)", "cast(shiftright(o_at, 32) as int)"
    pos, o_pos = "cast(shiftright(at & 4294967295L, 1) as int)", "cast(shiftright(o_at & 4294967295L, 1) as int)"
    this, other = "doc >= o_doc and (at & 1) = 1", "o_doc >= doc and (o_at & 1) = 1"
    fits = (
        f"({n} > {o_n} or {n} = {o_n} and set > o_set) and ({this} or {other}) and {_near(num, den, n, o_n)} "
        f"and 1 + least({n} - {pos} - 1, {o_n} - {o_pos} - 1) >= {_need(num, den, n, o_n)}"
    )
    slack = _slack(num, den, n, o_n)
    pair = lambda a, b: f"struct({a} as set, {b} as o_set, doc = o_doc as same, {slack} as slack)"
    found = F.expr(f"array_compact(array(if({this}, {pair('set', 'o_set')}, null), if({other}, {pair('o_set', 'set')}, null)))")
    return large.join(small, "token").where(fits).select(F.inline(found)).distinct()


def _proven(pairs: DataFrame, sets: DataFrame, docs: DataFrame, num: int, den: int) -> DataFrame:
    """set: those of pairs (set, o_set, slack; same: of one document) whose partner reaches num/den and is earlier.

    Each set is held against its likeliest partner first; only sets that this one does not prove are held against all of theirs.
    """
    ends = pairs.select("set").union(pairs.select("o_set")).distinct()
    held = bit_filter(ends.select(F.col("set").alias("key")))
    at = checkpointed(sets.where(held.holds(F.col("set"))).join(ends, "set", "left_semi").select("set", "first"))
    held = bit_filter(at.select(F.expr("xxhash64(first.doc, first.th, first.line_no)").alias("key")))
    text = _lines(docs).where(held.holds(F.xxhash64(*PLACE)))
    toks = text.join(at.select("set", "first.*"), PLACE).select("set", _hashes(F.col("line")).alias("toks"))
    toks = checkpointed(toks.dropDuplicates(["set"]))
    if "same" in pairs.columns:
        earlier = at.select(F.col("set").alias("o_set"), F.col("first").alias("o_first"))
        own = pairs.where("same").join(at, "set").join(earlier, "o_set").where("o_first < first")
        pairs = pairs.where("not same").union(own.select(*pairs.columns))
    other = toks.select(F.col("set").alias("o_set"), F.col("toks").alias("o_toks"))

    def reach(some: DataFrame) -> DataFrame:
        both = some.join(toks, "set").join(other, "o_set").withColumn("shared", F.size(F.array_intersect("toks", "o_toks")))
        return both.where(f"{den} * shared >= {num} * (size(toks) + size(o_toks) - shared)").select("set").distinct()

    if "same" not in pairs.columns:  # leaders, one of each set
        return checkpointed(reach(pairs))
    likely = checkpointed(reach(pairs.groupBy("set").agg(F.max_by("o_set", F.struct("slack", "o_set")).alias("o_set"))))
    return checkpointed(likely.union(reach(pairs.join(likely, "set", "left_anti"))))


def _removed(docs: DataFrame, num: int, den: int, min_tokens: int) -> DataFrame:
    """doc, th and removed (line numbers from 0, ascending); docs: doc, th, text."""
    with tidy(docs.sparkSession):
        classes = rarity_classes(docs)
        whole = line_sets(docs, classes, num, den)
        whole = materialize(whole.where(F.col("n") >= min_tokens) if min_tokens > 1 else whole)
        first = F.min(F.struct(*PLACE)).alias("first")
        # Dealt first: most sets are single, so a sort for partial results would be for nothing.
        sets = checkpointed(whole.repartition("set").groupBy("set").agg(first, F.first("n").alias("n"), *[F.first(c).alias(c) for c in SIGS], F.first("prefix").alias("prefix")))
        lines = materialize(whole.select(*PLACE, "set"))
        drop(whole)
        proven = _proven(checkpointed(_led(sets, num, den)), sets, docs, num, den)
        settle(docs.sparkSession)
        held = bit_filter(proven.select(F.col("set").alias("key"))).holds(F.col("set"))
        probes = sets.where(~held).union(sets.where(held).join(proven, "set", "left_anti"))
        others = sets.where(held).join(proven, "set", "left_semi")
        # One part of the tokens after another: the join's rows are the most that is on disk at once.
        joined = [checkpointed(_joined(probes, others, num, den, part)) for part in range(PARTS)]
        pairs = checkpointed(reduce(DataFrame.union, joined).distinct())
        settle(docs.sparkSession)
        found = proven.union(_proven(pairs, sets, docs, num, den))
        held = bit_filter(found.select(F.col("set").alias("key"))).holds(F.col("set"))
        maybe = sets.where(held).join(found.withColumn("gone", F.lit(True)), "set", "left").select("set", "first", F.coalesce("gone", F.lit(False)).alias("gone"))
        placed = sets.where(~held).select("set", "first", F.lit(False).alias("gone")).union(maybe)
        every = lines.join(placed, "set").where(F.col("gone") | (F.struct(*PLACE) != F.col("first")))
        out = checkpointed(every.groupBy("doc", "th").agg(F.array_sort(F.collect_set("line_no")).alias("removed")))
        drop(lines)
        return out


def dedup_report(docs: DataFrame, key: str = "doc_id", text: str = "text", num: int = 4, den: int = 5, min_tokens: int = 1) -> DataFrame:
    """One row a document: key, n_lines, n_removed, removed_lines."""
    p = Plain(docs)
    k, t = p[key], p[text]
    body = p.df.select(F.col(k).alias("doc"), F.xxhash64(F.coalesce(F.col(t), F.lit(""))).alias("th"), F.col(t).alias("text"))
    found = _removed(body, num, den, min_tokens)
    slim = body.select("doc", "th", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return slim.join(found, ["doc", "th"], "left").select(F.col("doc").alias(key), "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed_lines"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", num: int = 4, den: int = 5, min_tokens: int = 1) -> DataFrame:
    """docs with the redundant lines taken out of the text; every document stays."""
    p = Plain(docs)
    k, t = p[key], p[text]
    th = F.xxhash64(F.coalesce(F.col(t), F.lit("")))
    found = _removed(p.df.select(F.col(k).alias("doc"), th.alias("th"), F.col(t).alias("text")), num, den, min_tokens)
    parts = F.split(F.col(t), "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("removed"))
    new = F.when(F.col("removed").isNull(), F.col(t)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n"))
    rows = p.df.withColumn("th", th).join(found.withColumnRenamed("doc", k), [k, "th"], "left")
    return p.back(rows.withColumn(t, new))
