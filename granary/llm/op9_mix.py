"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that they belong to). A flow network leads words from patterns to
source quotas: the first use of a word costs nothing, every repetition more than the one before (convex), so the cheapest flow that
fills the quotas repeats as little as it can. Sources that share no document with another need no flow: their one pattern fills the quota. Only the
patterns' totals reach the driver, a row a pattern; tables of more than ``max_patterns`` patterns are joined, not broadcast.

Each copy of a pattern is cut in seeded order, after the words that the flow gives to each source. The cut's place comes from a histogram over ``buckets`` hash
ranges of each pattern, then running sums inside the one range that it falls into, so no task holds a pattern; the documents themselves are
not shuffled. Whole documents are taken, so what a source takes misses its quota by less than one document for each copy.

Defined cases: null text has size 0; null sources are a source of their own, last in order; a document of size 0 is taken 0 words; the seeded order
hashes id, seed and the whole row, so only wholly equal rows tie: they are counted, and of those at a cut as many are taken as
begin within the room; an empty table gives no rows; columns named like a result, in whatever case, are replaced. Reruns agree.
"""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import Plain, drop, materialize, words_of

#: Copies of one row that are written out together.
RUN = 10_000


def share_targets(sizes: dict[str | None, int], weights: tuple[float, ...] = (5, 2, 1), total_share: float = 1.5, cap: float = 2.0) -> dict[str | None, float]:
    """Targets by repeating weights over sources in code point order (null last); what is over cap * size is reshared by weight."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = total_share * sum(sizes.values()), list(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if unit * weight[s] > cap * sizes[s]]
        if not over:
            return out | {s: unit * weight[s] for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


@dataclass(frozen=True)
class Share:
    """Words of a pattern's copy (0: first use) that go to a source."""

    pattern: int
    source: int
    copy: int
    words: int


def min_cost_flow(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], copies: int = 2) -> list[Share]:
    """Successive shortest paths: patterns (members, words) supply ``copies`` uses at convex costs; quotas are filled as far as they can be."""
    n_p, n_s = len(patterns), len(quotas)
    source, sink = n_p + n_s, n_p + n_s + 1
    edges: list[list[int]] = []  # to, capacity, cost
    out: list[list[int]] = [[] for _ in range(n_p + n_s + 2)]

    def edge(a: int, b: int, room: int, cost: int) -> int:
        out[a].append(len(edges))
        edges.append([b, room, cost])
        out[b].append(len(edges))
        edges.append([a, 0, -cost])
        return len(edges) - 2

    use = [[edge(source, p, words, c * c) for c in range(copies)] for p, (_, words) in enumerate(patterns)]
    to = {(p, s): edge(p, n_p + s, words * copies, 0) for p, (members, words) in enumerate(patterns) for s in members}
    for s, q in enumerate(quotas):
        edge(n_p + s, sink, q, 0)
    potential = [0] * len(out)
    while True:
        dist, came = {source: 0}, {}
        heap = [(0, source)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > dist[a]:
                continue
            for k in out[a]:
                b, room, cost = edges[k]
                if room > 0 and (e := d + cost + potential[a] - potential[b]) < dist.get(b, 1 << 60):
                    dist[b], came[b] = e, k
                    heapq.heappush(heap, (e, b))
        if sink not in dist:
            break
        for v, d in dist.items():
            potential[v] += min(d, dist[sink])
        for v in set(range(len(out))) - set(dist):
            potential[v] += dist[sink]
        path, v = [], sink
        while v != source:
            path.append(came[v])
            v = edges[came[v] ^ 1][0]
        push = min(edges[k][1] for k in path)
        for k in path:
            edges[k][1] -= push
            edges[k ^ 1][1] += push
    shares = []
    for p, _ in enumerate(patterns):
        room = [edges[k ^ 1][1] for k in use[p]]
        for s in range(n_s):
            flow = edges[to[p, s] ^ 1][1] if (p, s) in to else 0
            for c in range(copies):
                took = min(flow, room[c])
                if took:
                    shares.append(Share(p, s, c, took))
                    flow, room[c] = flow - took, room[c] - took
    return shares


def route(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], copies: int = 2) -> list[Share]:
    """min_cost_flow, solved at once for sources that no document shares with another: their only pattern fills the quota use after use."""
    tied = {s for members, _ in patterns if len(members) > 1 for s in members}
    out, rest = [], []
    for p, (members, words) in enumerate(patterns):
        if tied.intersection(members):
            rest.append(p)
            continue
        for s in members:
            left = quotas[s]
            for c in range(copies):
                if took := min(left, words):
                    out.append(Share(p, s, c, took))
                    left -= took
    return out + [Share(rest[x.pattern], x.source, x.copy, x.words) for x in min_cost_flow([patterns[p] for p in rest], quotas, copies)]


def mix_sources(docs: DataFrame, members: Column, size: Column, key: str = "doc_id", seed: str = "mix", weights: tuple[float, ...] = (5, 2, 1), total_share: float = 1.5, copies: int = 2, buckets: int = 4096, max_patterns: int = 4096) -> DataFrame:
    """docs with _members (sorted array of source names), size, source_size, target, copies, taken and serves (the source that each copy's words go to).

    With one source a document, source_size and target are that source's; with several they are sums over its sources.
    """
    spark, p = docs.sparkSession, Plain(docs)
    own = p.df.columns
    body = docs.select("*", members.alias("members"), size.cast("long").alias("size")).toDF(*own, "members", "size")
    name = F.coalesce(F.col(p[key]).cast("string"), F.lit("null"))
    row = F.xxhash64(F.to_json(F.struct(*own))) if "map<" in p.df.schema.simpleString() else F.xxhash64(*own)  # maps have no hash
    h = F.conv(F.substring(F.md5(F.concat(name, F.lit(f"|{seed}|"), row.cast("string"))), 1, 15), 16, 10).cast("long")
    k = F.to_json(F.struct(F.array_sort(F.array_distinct("members")).alias("m")), {"ignoreNullFields": "false"})
    keyed = body.withColumns({"k": k, "h": h})
    bucket = F.shiftright("h", 60 - (buckets - 1).bit_length()).cast("int")
    slim = materialize(keyed.select("k", "h", "size", bucket.alias("bucket")))
    sums = slim.groupBy("k", "bucket").agg(F.sum("size").alias("n"))
    totals = sums.groupBy("k").agg(F.sum("n").alias("words")).collect()
    patterns = sorted((([(m is None, m or "") for m in x], x, r["k"], int(r["words"])) for r in totals for x in [json.loads(r["k"])["m"]]), key=lambda x: x[0])
    sizes: dict[str | None, int] = {}
    for _, m, _, words in patterns:
        for s in m:
            sizes[s] = sizes.get(s, 0) + words
    all_words = sum(x[3] for x in patterns)
    targets = share_targets(sizes, weights, total_share * all_words / max(1, sum(sizes.values())), copies)
    order = list(targets)
    at = {s: i for i, s in enumerate(order)}
    shares = route([(tuple(at[s] for s in m), words) for _, m, _, words in patterns], [round(targets[s]) for s in order], copies)
    # Each copy's words go to one source after another: where a source's part of them ends, as pattern, copy, running total and source.
    bounds, room = [], {}
    for x in sorted(shares, key=lambda x: (x.pattern, x.copy, x.source)):
        room[x.pattern, x.copy] = room.get((x.pattern, x.copy), 0) + x.words
        bounds.append((patterns[x.pattern][2], x.copy, room[x.pattern, x.copy], order[x.source]))

    def few(df: DataFrame) -> DataFrame:
        """A table of a few rows a pattern: broadcast up to max_patterns, beyond that Spark decides."""
        return F.broadcast(df) if len(patterns) <= max_patterns else df

    flow = spark.createDataFrame([b[:3] for b in bounds], "k string, copy int, room long")
    # The range that each cut falls into, then the hash inside that range at which the room ends: a row a pattern and copy.
    upto = F.sum("n").over(W.partitionBy("k").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
    ranges = sums.select("k", "bucket", "n", upto.alias("upto")).join(few(flow), "k")
    ranges = ranges.where("upto >= room and upto - n < room").select("k", "copy", "room", "bucket", (F.col("upto") - F.col("n")).alias("offset"))
    inside = slim.join(few(ranges), ["k", "bucket"]).groupBy("k", "bucket", "copy", "room", "offset", "h").agg(F.count("*").alias("rows"), F.sum("size").alias("words"))
    start = F.sum("words").over(W.partitionBy("k", "bucket", "copy", "room").orderBy("h").rowsBetween(W.unboundedPreceding, -1))
    inside = inside.withColumn("start", F.col("offset") + F.coalesce(start, F.lit(0))).where("start < room")
    cut_at = {(r["k"], r["copy"], r["room"]): r["cut"] for r in inside.groupBy("k", "copy", "room").agg(F.max(F.struct("h", "rows", "words", "start", "room")).alias("cut")).collect()}
    drop(slim)
    ends: dict[str, list] = {}
    for k_, c, total, s in bounds:
        if (k_, c, total) in cut_at:
            ends.setdefault(k_, []).append((c, cut_at[k_, c, total]["h"], s))
    cuts = {(k_, c): cut_at[k_, c, total] for k_, c, total, _ in bounds if (k_, c, total) in cut_at}  # the last bound of a copy
    # Of equal rows at a cut, as many are taken as begin within the room.
    parted = []
    for (name_, c), x in cuts.items():
        taken = x["rows"] if not x["words"] else min(x["rows"], -(-(x["room"] - x["start"]) * x["rows"] // x["words"]))
        if taken < x["rows"]:
            parted.append((name_, x["h"], c, taken))
    split = {(name_, c): t for name_, _, c, t in parted}
    plan = spark.createDataFrame(
        [(k, float(sum(targets[s] for s in m)), sum(sizes[s] for s in m), [cuts[k, c]["h"] if (k, c) in cuts else -1 for c in range(copies)], [split.get((k, c)) for c in range(copies)], ends.get(k, [])) for _, m, k, _ in patterns],
        "k string, target double, source_size long, last array<long>, first_rows array<long>, ends array<struct<copy: int, h: long, source: string>>",
    )
    rows = keyed.join(few(plan), "k")
    every = f"sequence(0, {copies - 1})"
    out = rows.withColumn("uses", F.expr(f"filter({every}, c -> h <= last[c])"))
    if parted:
        equal = F.expr("exists(arrays_zip(last, first_rows), x -> x.last = h and x.first_rows is not null)")
        one = rows.where(equal).groupBy("k", "h").agg(F.first(F.struct(*[c for c in rows.columns if c not in ("k", "h")])).alias("row"), F.count("*").alias("rows"))
        one = one.select("k", "h", "rows", "row.*").withColumn("run", F.explode(F.expr(f"sequence(0L, (rows - 1) div {RUN})")))
        one = one.withColumn("i", F.explode(F.expr(f"sequence(run * {RUN}, least((run + 1) * {RUN}, rows) - 1)")))
        uses = F.expr(f"filter({every}, c -> h < last[c] or (h = last[c] and (first_rows[c] is null or i < first_rows[c])))")
        out = out.where(~equal).unionByName(one.withColumn("uses", uses).select(*out.columns))
    serves = F.expr("transform(uses, c -> get(filter(ends, x -> x.copy = c and h <= x.h), 0).source)")
    out = out.withColumns({"copies": F.size("uses"), "serves": serves, "_members": F.from_json("k", "m array<string>")["m"]})
    return p.back(out.withColumn("taken", F.col("size") * F.col("copies")), "_members", "size", "source_size", "target", "copies", "taken", "serves")


def mix_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **kw) -> DataFrame:
    """mix_sources for documents of one source each."""
    p = Plain(docs)
    mixed = mix_sources(p.df, F.array(F.col(p[source])), F.size(words_of(F.col(p[text]))), p[key], **kw)
    return p.back(mixed, "_members", "size", "source_size", "target", "copies", "taken", "serves")
