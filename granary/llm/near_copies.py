"""Near-copies by SimHash and an exact set-similarity join (Jaccard of word shingles, num/den or more).

A document's set holds the 64-bit XXH64 of its shingles; two shingles of one hash count as equal. Documents with equal sets are one node, so copies never
pair up. Shingles are ordered by rarity (the frequency of their hash range, then the hash): sets that reach the threshold share one of their
n - ceil(n * num / den) + 1 rarest shingles, so nodes that meet in one and pass the length and positional filters are candidates, and the whole sets decide.

SimHash goes first: sets whose fingerprints are equal or meet in op2_simhash's grid at ``FP_BITS`` or fewer differing bits are candidates, and so are each set
and a few leaders, the smallest sets with one of its min-hashes. The whole sets decide here too, and the links found give labels. Near copies whose
fingerprints lie further apart are left to the prefix join, where only sets of different labels pair up, so a group of k near copies gives about k links and not all pairs; what is
asked for are groups, and a link inside a label changes none. No group is lost and none is joined below the threshold.

Defined cases: words are runs between ASCII white space, ASCII letters in lower case; under ``size`` words: one shingle, the whole sequence; a null
text has no words, and documents without words have equal sets; an empty table gives no rows; of wholly or partly equal rows with one id and one
text the one with the smallest row hash stays; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Plain, bit_filter, checkpointed, drop, materialize, settle, tidy
from .graph import components
from .op2_simhash import BLOCK, bit_sums, majority, near_links

COUNTERS, SEED, LEADS, LEADERS, FP_BITS = 1 << 20, 42, 6, 2, 4


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a whole text."""
    from xxhash import xxh64_intdigest as digest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    body = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(words) - size + 1)
    a, b = (ends - lengths)[:n].tolist(), ends[-n:].tolist()
    return np.unique(np.fromiter((digest(body[i:j], SEED) for i, j in zip(a, b, strict=True)), np.uint64, n))


def min_hashes(s: np.ndarray) -> np.ndarray:
    """``LEADS`` values, each the smallest of a set under another mixing; sets share one with the probability of their Jaccard similarity."""
    if not len(s):
        return np.zeros(0, np.int64)
    out = np.empty(LEADS, np.uint64)
    for k in range(LEADS):
        x = (s ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        out[k] = (x ^ (x >> np.uint64(31))).min()
    return out.view(np.int64)


def fingerprint_of(s: np.ndarray) -> int:
    """SimHash of a set of shingles."""
    return majority(sum((bit_sums(s[k : k + BLOCK]) for k in range(0, len(s), BLOCK)), np.zeros(64, np.int64)), len(s))


def parities(s: np.ndarray) -> bytes:
    """Which ranges of hashes hold an odd number of a set's shingles: a power of two bits, twice as many as shingles or more, 256 at least."""
    bits = max(256, 1 << (2 * len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def apart(a: bytes, b: bytes) -> int:
    """At most the symmetric difference of two sets, from their parities; the longer ones fold to the length of the shorter ones."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def shingle_sets(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """key, mark (a hash of the text), set (the 64-bit name of the set), n, fp (its fingerprint), leads (min_hashes) and shingles, the set as bytes, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as digest

        for x in batches:
            for i in range(0, len(x), 256):
                part = x.slice(i, 256)
                sets = [shingle_set(t.as_py(), size) for t in part["_text"]]
                raw = [s.tobytes() for s in sets]
                name = np.array([digest(r, SEED) for r in raw], np.uint64).view(np.int64)
                leads = pa.array([min_hashes(s) for s in sets], pa.list_(pa.int64()))
                fp = pa.array(np.array([fingerprint_of(s) for s in sets], np.uint64).view(np.int64))
                columns = [part["_key"], part["_mark"], pa.array(name), pa.array([len(s) for s in sets], pa.int32()), fp, leads, pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "mark", "set", "n", "fp", "leads", "shingles"])

    slim = docs.select(F.col(key).cast("long").alias("_key"), F.xxhash64(text).alias("_mark"), F.col(text).alias("_text"))
    return slim.mapInArrow(run, "key long, mark long, set long, n int, fp long, leads array<long>, shingles binary")


def _rarity(sets: DataFrame) -> np.ndarray:
    """For each hash range the class (0 to 63) of its frequency over the sets; at most COUNTERS places and classes, 5 MB, reach the driver.

    Ranges hold many shingles each in a large corpus; the more there are, the surer passages that many sets share come last and stay out of prefixes.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = np.zeros(COUNTERS, np.int64)
        for x in batches:
            for s in x["shingles"]:
                np.add.at(c, (np.frombuffer(s.as_py(), np.uint64) & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        at = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(c[at])], ["i", "c"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            level = np.minimum(63, np.floor(2 * np.log2(x["c"].to_numpy()))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x["i"].to_numpy(), level)], ["i", "level"])

    summed = sets.select("shingles").mapInArrow(count, "i int, c long").groupBy("i").agg(F.sum("c").alias("c"))
    out = np.zeros(COUNTERS, np.uint8)
    for r in summed.mapInArrow(pack, "i binary, level binary").toArrow().to_pylist():
        out[np.frombuffer(r["i"], np.int32)] = np.frombuffer(r["level"], np.uint8)
    return out


def _fingerprint_pairs(sets: DataFrame) -> DataFrame:
    """Pairs a, b of sets whose fingerprints are equal (each with the smallest such set) or link within FP_BITS bits."""
    nodes = checkpointed(sets.groupBy("fp").agg(F.min("set").alias("lead")))
    same = sets.select("set", "fp").join(nodes, "fp").where("set != lead").select("set", "lead")
    links = near_links(nodes, FP_BITS).join(nodes.toDF("a", "set"), "a").join(nodes.toDF("b", "lead"), "b").select("set", "lead")
    return same.union(links).select(F.least("set", "lead").alias("a"), F.greatest("set", "lead").alias("b"))


def _led(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs a, b of a set and a leader: the smallest set, in each of LEADERS hash ranges, with one of its min-hashes."""
    rows = sets.select("set", "n", F.posexplode("leads").alias("k", "value"))
    leads = rows.groupBy("k", "value", F.pmod("set", F.lit(LEADERS)).alias("part")).agg(F.min(F.struct("set", "n")).alias("lead"))
    leads = leads.select("k", "value", F.col("lead.set").alias("a"), F.col("lead.n").alias("m"))
    near = F.expr(f"set != a and {den} * least(n, m) >= {num} * greatest(n, m)")
    return rows.join(leads, ["k", "value"]).where(near).select(F.least("a", "set").alias("a"), F.greatest("a", "set").alias("b")).distinct()


def cross_pairs(token: np.ndarray, label: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs of rows with one token and different labels; rows are sorted by token, then label. Pairs of one label are not even looked at."""
    cut = np.flatnonzero(np.r_[True, (token[1:] != token[:-1]) | (label[1:] != label[:-1])]) if len(token) else np.zeros(0, np.int64)
    after = np.r_[cut[1:], len(token)]
    first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.zeros(0, np.int64)
    end_of = np.r_[first[1:], len(token)]
    # Each row meets the rows of its token that follow its run of one label.
    begin = np.repeat(after, after - cut)
    end = np.repeat(end_of, end_of - first)
    todo = np.flatnonzero(end > begin)
    width = (end - begin)[todo]
    total = np.r_[0, np.cumsum(width)]
    i = 0
    while i < len(todo):
        j = max(i + 1, int(np.searchsorted(total, total[i] + most, side="right")) - 1)
        w = width[i:j]
        left = np.repeat(todo[i:j], w)
        yield left, np.repeat(begin[todo[i:j]], w) + np.arange(len(left)) - np.repeat(total[i:j] - total[i], w)
        i = j


def _candidates(sets: DataFrame, rarity: np.ndarray, num: int, den: int) -> DataFrame:
    """Pairs a < b of sets of different labels that may reach num/den; sets: set, label, shingles."""
    shared = sets.sparkSession.sparkContext.broadcast(rarity)  # COUNTERS bytes

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for k in range(0, len(x), 256):
                part = x.slice(k, 256)
                tokens, owners, labels, places = [], [], [], []
                for name, label, raw in zip(part["set"].to_pylist(), part["label"].to_pylist(), part["shingles"], strict=True):
                    s = np.frombuffer(raw.as_py(), np.uint64)
                    n = len(s)
                    most = n - -(-n * num // den) + 1
                    rare = s[np.lexsort((s, shared.value[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]))[:most]]
                    tokens.append(rare.view(np.int64))
                    owners.append(np.full(most, name, np.int64))
                    labels.append(np.full(most, label, np.int64))
                    places.append(np.arange(most, dtype=np.int64) | n << 32)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (tokens, owners, labels, places)], ["token", "set", "label", "at"])

    def pairs(parts: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(parts)
        order = np.lexsort((rows["label"].to_numpy(), rows["token"].to_numpy()))
        token, name, label, at = (rows[c].to_numpy()[order] for c in ("token", "set", "label", "at"))
        n, pos = at >> 32, at & 0xFFFFFFFF
        for i, j in cross_pairs(token, label):
            need = -(-num * (n[i] + n[j]) // (num + den))
            fits = (den * np.minimum(n[i], n[j]) >= num * np.maximum(n[i], n[j])) & (1 + np.minimum(pos[i], pos[j]) + np.minimum(n[i] - pos[i] - 1, n[j] - pos[j] - 1) >= need)
            a, b = name[i[fits]], name[j[fits]]
            if len(a):
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for x in batches:
            if not len(x):
                continue
            cut = int(np.searchsorted(x["token"].to_numpy(), x["token"].iloc[-1]))  # the last token may go on
            if cut:
                yield from pairs([*held, x.iloc[:cut]])
                held = []
            held.append(x.iloc[cut:])
        if held:
            yield from pairs(held)

    rows = sets.select("set", "label", "shingles").mapInArrow(prefixes, "token long, set long, label long, at long")
    return rows.repartition("token").sortWithinPartitions("token").mapInPandas(meet, "a long, b long").distinct()


def _joined(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, n, m, s, t: pairs with both sizes and sets (set, n, shingles)."""
    ends = pairs.select(F.col("a").alias("set")).union(pairs.select(F.col("b").alias("set"))).distinct()
    held = bit_filter(ends.select(F.col("set").alias("key"))).holds(F.col("set"))  # only spares the other sets the shuffle
    found = sets.where(held).select("set", "n", "shingles")
    s, t = found.toDF("a", "n", "s"), found.toDF("b", "m", "t")
    return pairs.select("a", "b").join(s, "a").join(t, "b").select("a", "b", "n", "m", "s", "t")


def _overlaps(x: pa.RecordBatch) -> np.ndarray:
    return np.array([len(np.intersect1d(np.frombuffer(s.as_py(), np.uint64), np.frombuffer(t.as_py(), np.uint64), assume_unique=True)) for s, t in zip(x["s"], x["t"], strict=True)], np.int64)


def _reach(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose whole sets reach num/den; sets: set, n, shingles.

    The parities of the sets go first: their Hamming distance is at most the symmetric difference, and only pairs that may still reach the
    threshold have their whole sets brought together.
    """

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            some = [parities(np.frombuffer(r.as_py(), np.uint64)) for r in x["shingles"]]
            yield pa.RecordBatch.from_arrays([x["set"], x["n"], pa.array(some, pa.binary())], ["set", "n", "shingles"])

    def may(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            n, m = (x[c].to_numpy().astype(np.int64) for c in ("n", "m"))
            differ = np.array([apart(s.as_py(), t.as_py()) for s, t in zip(x["s"], x["t"], strict=True)], np.int64)
            yield x.select(["a", "b"]).filter(pa.array(differ <= n + m - 2 * -(-num * (n + m) // (num + den)), pa.bool_()))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            n, m = (x[c].to_numpy().astype(np.int64) for c in ("n", "m"))
            both = _overlaps(x)
            yield x.select(["a", "b"]).filter(pa.array(den * both >= num * (n + m - both), pa.bool_()))

    thin = sets.select("set", "n", "shingles").mapInArrow(small, "set long, n int, shingles binary")
    left = checkpointed(_joined(pairs, thin).mapInArrow(may, "a long, b long"))
    return _joined(left, sets).mapInArrow(verify, "a long, b long")


def _labels(links: DataFrame) -> DataFrame:
    """set and label of the ends of links: the smallest set within three links. Equal labels are in one group; a group may have several, which only costs work."""
    both = links.select(F.col("a").alias("set"), F.col("b").alias("other")).union(links.select(F.col("b").alias("set"), F.col("a").alias("other")))
    out = both.groupBy("set").agg(F.least(F.min("set"), F.min("other")).alias("label"))
    for _ in range(2):
        out = both.join(out.withColumnRenamed("set", "other"), "other").groupBy("set").agg(F.least(F.min("set"), F.min("label")).alias("label"))
    return out


def near_groups(rows: DataFrame, num: int = 4, den: int = 5) -> DataFrame:
    """node (a set) and label (the smallest set that links reach) of sets with a link; rows: the table of shingle_sets, materialized."""
    names = rows.select("set").groupBy("set").count().where("count > 1").select("set")
    several = bit_filter(names.select(F.col("set").alias("key"))).holds(F.col("set"))
    columns = ["set", "n", "fp", "leads", "shingles"]
    # One row a set; only sets that more than one row may have move.
    sets = rows.where(~several).select(*columns).union(rows.where(several).select(*columns).dropDuplicates(["set"])).where("n > 0")
    met = checkpointed(_fingerprint_pairs(sets).union(_led(sets, num, den)).distinct())
    led = checkpointed(_reach(met, sets, num, den))
    settle(rows.sparkSession)
    labels = checkpointed(_labels(led))
    known = bit_filter(labels.select(F.col("set").alias("key"))).holds(F.col("set"))
    labelled = sets.where(known).join(labels, "set", "left").select("set", F.coalesce("label", "set").alias("label"), "shingles")
    labelled = sets.where(~known).select("set", F.col("set").alias("label"), "shingles").union(labelled)
    pairs = checkpointed(_candidates(labelled, _rarity(sets), num, den))
    settle(rows.sparkSession)
    return components(led.union(_reach(pairs, sets, num, den)).select(F.col("a").alias("u"), F.col("b").alias("v")))


def _judged(rows: DataFrame, num: int, den: int) -> DataFrame:
    """key, mark and stays of the rows whose group has others; rows: the table of shingle_sets."""
    sets = materialize(rows)
    groups = near_groups(sets, num, den)
    settle(rows.sparkSession)
    own = sets.select("key", "mark", "set")
    known = bit_filter(groups.select(F.col("node").alias("key"))).holds(F.col("set"))
    found = own.where(known).join(groups.withColumnRenamed("node", "set"), "set", "left").select("key", "mark", F.coalesce("label", "set").alias("label"))
    own = own.where(~known).select("key", "mark", F.col("set").alias("label")).union(found)
    order = F.struct(F.col("key").isNull(), "key", "mark")
    firsts = own.groupBy("label").agg(F.min(order).alias("o"), F.count("*").alias("n"))
    # Rows that are alone in their group stay where they are; the others, by id and text hash, are judged.
    out = checkpointed(own.join(firsts.where("n > 1").select("label", "o"), "label").select("key", "mark", (order == F.col("o")).alias("stays")).distinct())
    drop(sets)
    return out


def first_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """One row of each group that links reach: the smallest id, rows without an id last, then the smallest text hash; of rows equal in both, one."""
    p = Plain(docs)
    rows = p.df.withColumns({"id": F.col(p[key]).cast("long"), "mark": F.xxhash64(p[text])})
    with tidy(docs.sparkSession):
        judged = _judged(shingle_sets(p.df, p[key], p[text], size), num, den)
        name = F.xxhash64(F.coalesce("id", F.lit(-1)), "mark")
        held = bit_filter(judged.select(F.xxhash64(F.coalesce("key", F.lit(-1)), "mark").alias("key"))).holds(name)
    columns = p.df.columns
    some = rows.where(held).join(judged.withColumnRenamed("mark", "j_mark"), F.col("id").eqNullSafe(F.col("key")) & (F.col("mark") == F.col("j_mark")), "left").where(F.coalesce("stays", F.lit(True)))
    place = F.row_number().over(W.partitionBy("id", "mark").orderBy(F.xxhash64(*columns)))
    some = some.withColumn("place", F.when(F.col("stays").isNull(), 1).otherwise(place)).where("place = 1")
    return p.back(rows.where(~held).select(*columns).union(some.select(*columns)))
