"""Substring dedup: repeated windows of words by compressed FM-indexes over shards.

Words of documents that share a window of ``window`` words share an anchor: the smallest hash of ``GRAM`` words inside the window. Each document is cut into
the segments whose windows choose the same anchor, and segments of an anchor that several documents have meet in one shard; the rest, nearly
all, never move. Equal segments are one text, indexed for their smallest holder. A shard builds a compressed FM-index (fm_index) of its texts and streams them
through it, once for the first holder and once for the later ones: backward search gives the matching statistics against smaller documents, and
intervals of at least ``window`` words are reported.

A shard holds about ``SHARD_WORDS`` words and at most ``CHUNK`` texts of one anchor. Segments of anchors with more (a passage inside very many different
contexts, a crowd of near copies) are first cut to their runs of windows that some other segment seems to have, by a filter that counts to two; runs are
few where segments are many, for what differs has gone. An anchor with more than ``CHUNK`` different runs goes by window, each window that documents share
being one text, so that neither a group nor the work grows faster than the rows. Words are compared by their 64-bit XXH64.

Defined cases: null texts have no words; documents under ``window`` words lose none; a document's own repeats do not count; equal ids with equal texts
are one document, with different texts they are judged apart and never against each other; rows without an id keep all words and remove none; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Plain, bit_filter, checkpointed, drop, materialize, tidy
from .fm_index import FMIndex

WINDOW, GRAM, CHUNK, SHARD_WORDS = 50, 8, 1000, 400_000
PRIME = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest as digest

    return np.fromiter(map(digest, words), np.uint64, len(words))


def _powers(p: np.uint64, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(n - 1, 0), p, np.uint64)])[:n]


def segments(h: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """anchor hash, segment hash, start and length of the segments of a document's word hashes."""
    n = len(h)
    if n < window:
        return (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32))
    m = n - gram + 1
    g = np.zeros(m, np.uint64)
    for j in range(gram):
        g = g * PRIME + h[j : j + m]
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(32)
    # Leftmost place of the minimum over each window's grams, by doubling.
    width, at = 1, np.arange(m)
    span = window - gram + 1
    while width < span:
        step = min(width, span - width)
        a, b = at[: len(at) - step], at[step:]
        at = np.where(g[b] < g[a], b, a)
        width += step
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[first[1:], len(at)] - 1
    length = last - first + window
    total = np.r_[np.uint64(0), np.cumsum(h * _powers(PRIME, n))]
    seg = (total[first + length] - total[first]) * _powers(INVERSE, n)[first]
    return g[at[first]], seg ^ length.astype(np.uint64), first.astype(np.int32), length.astype(np.int32)


def _segment_table(docs: DataFrame, window: int) -> DataFrame:
    """doc, th (hash of the text), anchor, seg, start, len."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            parts = []
            for i, t in enumerate(x["text"]):
                a, s, b, n = segments(word_hashes(split_words(t.as_py())), window)
                parts.append((np.full(len(a), i), a, s, b, n))
            if not parts:
                continue
            i, a, s, b, n = (np.concatenate([p[k] for p in parts]) for k in range(5))
            at = pa.array(i.astype(np.int64))
            yield pa.RecordBatch.from_arrays([x["doc"].take(at), x["th"].take(at), pa.array(a.view(np.int64)), pa.array(s.view(np.int64)), pa.array(b), pa.array(n)], ["doc", "th", "anchor", "seg", "start", "len"])

    return docs.mapInArrow(run, "doc long, th long, anchor long, seg long, start int, len int")


def _fetch(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted's rows (doc, th, start, len, anchor, seg, last, n) with the segment's words (hashes, as bytes) instead of its place."""
    lists = wanted.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "len", "anchor", "seg", "last", "n")).alias("want"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for i in range(0, len(x), 256):
                part = x.slice(i, 256)
                rows = []
                for d, t, want in zip(part["doc"].to_pylist(), part["text"], part["want"], strict=True):
                    h = word_hashes(split_words(t.as_py()))
                    rows += [(d, w["anchor"], w["seg"], w["last"], w["n"], h[w["start"] : w["start"] + w["len"]].tobytes()) for w in want.as_py()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate([pa.int64()] * 5 + [pa.binary()])], ["doc", "anchor", "seg", "last", "n", "words"])

    return _only(docs, wanted).join(lists, ["doc", "th"]).select("doc", "text", "want").mapInArrow(run, "doc long, anchor long, seg long, last long, n long, words binary")


def _only(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Docs without most of those that a join with wanted would drop: only spares their shuffle."""
    return docs.where(bit_filter(wanted.select(F.xxhash64("doc", "th").alias("key")).distinct()).holds(F.xxhash64("doc", "th")))


FOUND = "anchor long, seg long, copy boolean, a int, b int"


def search_shard(x: pd.DataFrame, window: int) -> pd.DataFrame:
    """Intervals of a shard's texts that a text of a smaller document repeats: for the first holder of each, and (copy) for its later holders.

    The only text of an anchor (n is 1) is not searched for its first holder: there is nothing of a smaller document to find.
    """
    texts = [np.frombuffer(w, np.uint64) for w in x["words"]]
    vocabulary, ids = np.unique(np.concatenate(texts), return_inverse=True)
    texts = np.split(ids.astype(np.int32) + 1, np.cumsum([len(t) for t in texts])[:-1])
    first, last = x["doc"].to_numpy(np.int64), x["last"].to_numpy(np.int64)
    index = FMIndex(texts, first, len(vocabulary))
    own, later = np.flatnonzero(x["n"].to_numpy() > 1), np.flatnonzero(last > first)
    of = np.r_[own, later]
    found = index.repeated([texts[i] for i in of], np.r_[first[own], last[later]], window)
    rows = [(of[i], i >= len(own), a, b) for i, f in enumerate(found) for a, b in f]
    at = np.array([r[0] for r in rows], np.int64)
    return pd.DataFrame({"anchor": x["anchor"].to_numpy()[at], "seg": x["seg"].to_numpy()[at], "copy": np.array([r[1] for r in rows], bool), "a": np.array([r[2] for r in rows], np.int32), "b": np.array([r[3] for r in rows], np.int32)})


def _search(texts: DataFrame, words: int, window: int) -> DataFrame:
    """FOUND of texts (doc, anchor, seg, last, n, words), which meet by anchor in shards of about SHARD_WORDS of all ``words``."""
    shard = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-words // SHARD_WORDS)))).cast("int").alias("shard")
    return texts.select(shard, "doc", "anchor", "seg", "last", "n", "words").groupBy("shard").applyInPandas(lambda x: search_shard(x, window), FOUND)


def _window_names(h: np.ndarray, window: int) -> np.ndarray:
    """Hash of each window of a text's word hashes."""
    m = len(h) - window + 1
    total = np.r_[np.uint64(0), np.cumsum(h * _powers(PRIME, len(h)))]
    return (total[window:] - total[:m]) * _powers(INVERSE, len(h))[:m]


#: The filter of windows that occur again: bits a window, at most 2^AGAIN_LOG (2 MB) whatever it holds. With more windows it lets more of them through, and results stay.
AGAIN_BITS, AGAIN_LOG, AGAIN_PARTS = 16, 24, 16
AGAIN_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _places(names: np.ndarray, log: int) -> np.ndarray:
    """Places of each window in a filter of 2^log bits: one row a seed."""
    return (((names ^ (names >> np.uint64(32))) * AGAIN_SEEDS[:, None]) >> np.uint64(64 - log)).astype(np.int64)


def _again(texts: DataFrame, count: int, window: int) -> np.ndarray:
    """A filter of the windows of texts (``count`` in all) that occur more than once: each of those has all of its places set, of others few have."""
    log = min(AGAIN_LOG, max(16, (AGAIN_BITS * count - 1).bit_length()))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(1 << log, bool), np.zeros(1 << log, bool)
        for x in batches:
            for i in range(0, len(x), 256):
                names = np.concatenate([_window_names(np.frombuffer(raw.as_py(), np.uint64), window) for raw in x["words"].slice(i, 256)])
                at, times = np.unique(_places(names, log), return_counts=True)
                twice[at[(times > 1) | once[at]]] = True
                once[at] = True
        cut = [[b.tobytes() for b in np.split(np.packbits(bits), AGAIN_PARTS)] for bits in (once, twice)]
        yield pa.RecordBatch.from_arrays([pa.array(range(AGAIN_PARTS), pa.int32()), *(pa.array(c, pa.binary()) for c in cut)], ["part", "once", "twice"])

    def merge(x: pd.DataFrame) -> pd.DataFrame:
        once, twice = (np.zeros((1 << log) // 8 // AGAIN_PARTS, np.uint8) for _ in range(2))
        for o, t in zip(x["once"], x["twice"], strict=True):
            o = np.frombuffer(o, np.uint8)
            twice |= np.frombuffer(t, np.uint8) | (once & o)
            once |= o
        return pd.DataFrame({"part": x["part"].iloc[:1], "bits": [twice.tobytes()]})

    # One filter a core, not one a partition.
    marks = texts.select("words").coalesce(texts.sparkSession.sparkContext.defaultParallelism).mapInArrow(mark, "part int, once binary, twice binary")
    parts = sorted(marks.groupBy("part").applyInPandas(merge, "part int, bits binary").collect())
    return np.frombuffer(b"".join(bytes(r["bits"]) for r in parts), np.uint8)


def runs_of(h: np.ndarray, again: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Intervals of a text's words that are runs of windows which the filter knows."""
    at = _places(_window_names(h, window), (8 * len(again)).bit_length() - 1)
    seen = ((again[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)
    edges = np.flatnonzero(np.diff(np.r_[False, seen, False].astype(np.int8)))
    return [(int(a), int(b) - 1 + window) for a, b in edges.reshape(-1, 2)]


def _runs(texts: DataFrame, again: np.ndarray, window: int) -> DataFrame:
    """doc, anchor, seg, off, run (its hash), words: the runs of texts' windows that occur again."""
    shared = texts.sparkSession.sparkContext.broadcast(again)  # at most 2^AGAIN_LOG bits

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for i in range(0, len(x), 256):
                part = x.slice(i, 256)
                at, off, name, words = [], [], [], []
                for k, raw in enumerate(part["words"]):
                    h = np.frombuffer(raw.as_py(), np.uint64)
                    for a, b in runs_of(h, shared.value, window):
                        at.append(k)
                        off.append(a)
                        name.append((h[a:b] * _powers(PRIME, b - a)).sum(dtype=np.uint64) ^ np.uint64(b - a))
                        words.append(h[a:b].tobytes())
                columns = [part[c].take(pa.array(at, pa.int64())) for c in ("doc", "anchor", "seg")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(off, pa.int32()), pa.array(np.array(name, np.uint64).view(np.int64)), pa.array(words, pa.binary())], ["doc", "anchor", "seg", "off", "run", "words"])

    return texts.mapInArrow(cut, "doc long, anchor long, seg long, off int, run long, words binary")


def _search_hot(texts: DataFrame, window: int, chunk: int) -> DataFrame:
    """FOUND for anchors with very many different segments, through what segments have in common.

    Windows of one segment only are in no smaller document, so the runs of the others hold all there is to find, and equal runs are one text, owned by its
    smallest holder. A segment that several documents have is searched whole for its later holders, dealt by its own hash.
    """
    size = F.expr("length(words) div 8")
    each = materialize(_runs(texts, _again(texts, texts.agg(F.sum(size - window + 1)).first()[0], window), window))
    runs = each.groupBy("anchor", F.col("run").alias("seg")).agg(F.min("doc").alias("doc"), F.max("doc").alias("last"), F.min("words").alias("words"))
    runs = materialize(runs.join(runs.groupBy("anchor").agg(F.count("*").alias("n")), "anchor"))
    few, many = runs.where(F.col("n") <= chunk), runs.where(F.col("n") > chunk)
    found = _search(few, few.agg(F.sum(size)).first()[0] or 0, window)
    if not many.isEmpty():
        found = found.union(_search_windows(many, window))
    found = found.withColumnRenamed("seg", "run").join(runs.select("anchor", F.col("seg").alias("run"), F.col("doc").alias("low")), ["anchor", "run"])
    own = each.join(found, ["anchor", "run"]).where(F.col("copy") == (F.col("doc") > F.col("low")))
    own = own.select("anchor", "seg", F.lit(False).alias("copy"), (F.col("off") + F.col("a")).alias("a"), (F.col("off") + F.col("b")).alias("b"))
    held = texts.where("doc < last")
    alone = held.select("doc", F.col("seg").alias("anchor"), F.col("anchor").alias("seg"), "last", F.lit(1).cast("long").alias("n"), "words")
    copies = _search(alone, held.agg(F.sum(size)).first()[0] or 0, window).where("copy")
    out = checkpointed(own.union(copies.select(F.col("seg").alias("anchor"), F.col("anchor").alias("seg"), "copy", "a", "b")))
    drop(each)
    drop(runs)
    return out


def _search_windows(texts: DataFrame, window: int) -> DataFrame:
    """FOUND for anchors with very many different texts still: their windows meet by window hash instead, so no group grows with an anchor.

    Each window that documents share is one text of the index, owned by its smallest holder and searched for its largest; a segment's intervals are its
    windows found that way.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for i in range(0, len(x), 256):
                part = x.slice(i, 256)
                at, off, name = [], [], []
                for k, raw in enumerate(part["words"]):
                    h = np.frombuffer(raw.as_py(), np.uint64)
                    name.append(_window_names(h, window))
                    at.append(np.full(len(name[-1]), k))
                    off.append(np.arange(len(name[-1]), dtype=np.int32))
                at = pa.array(np.concatenate(at).astype(np.int64))
                columns = [part[c].take(at) for c in ("doc", "anchor", "seg", "last")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(off)), pa.array(np.concatenate(name).view(np.int64))], ["doc", "anchor", "seg", "last", "off", "window"])

    each = materialize(texts.mapInArrow(windows, "doc long, anchor long, seg long, last long, off int, window long"))
    shared = each.groupBy("window").agg(F.min(F.struct("doc", "anchor", "seg", "off")).alias("first"), F.max("last").alias("high")).where("first.doc < high")
    shared = checkpointed(shared.select("window", "first.*", "high"))
    cut = F.expr(f"substring(words, 8 * off + 1, {8 * window})").alias("words")
    body = shared.join(texts.select("anchor", "seg", "words"), ["anchor", "seg"]).select("doc", F.col("window").alias("anchor"), F.lit(0).cast("long").alias("seg"), F.col("high").alias("last"), F.lit(1).cast("long").alias("n"), cut)
    sure = _search(body, shared.count() * window, window).where("copy").select(F.col("anchor").alias("window")).distinct()
    sure = sure.join(shared.select("window", F.col("doc").alias("low")), "window")
    hits = each.join(sure, "window")
    place = [F.col("off").alias("a"), (F.col("off") + window).alias("b")]
    # A window of a segment counts for its first holder if a smaller document has it, and for later holders if one smaller than they has.
    kinds = F.explode(F.array_compact(F.array(F.when(F.col("low") < F.col("doc"), False), F.when((F.col("low") < F.col("last")) & (F.col("doc") < F.col("last")), True)))).alias("copy")
    out = checkpointed(hits.select("anchor", "seg", kinds, *place))
    drop(each)
    return out


def repeated_intervals(docs: DataFrame, window: int = WINDOW, chunk: int = CHUNK) -> DataFrame:
    """doc, th, a, b: word intervals of docs (doc, th, text) that a smaller document repeats."""
    with tidy(docs.sparkSession):
        every = materialize(_segment_table(docs, window))
        shared = every.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("anchor")
        shared = checkpointed(shared)
        near = bit_filter(shared.select(F.col("anchor").alias("key"))).holds(F.col("anchor"))
        some = checkpointed(every.where(near).join(shared, "anchor", "left_semi"))
        drop(every)
        firsts = some.groupBy("anchor", "seg").agg(F.min(F.struct("doc", "th", "start", "len")).alias("first"), F.max("doc").alias("last")).select("anchor", "seg", "first.*", "last")
        kinds = checkpointed(firsts.join(firsts.groupBy("anchor").agg(F.count("*").alias("n")), "anchor"))
        usual, hot = kinds.where(F.col("n") <= chunk), kinds.where(F.col("n") > chunk)
        found, texts = _search(_fetch(docs, usual), usual.agg(F.sum("len")).first()[0] or 0, window), None
        if not hot.isEmpty():
            texts = materialize(_fetch(docs, hot))
            found = found.union(_search_hot(texts, window, chunk))
        parts = [F.collect_set(F.when(F.col("copy") == c, F.struct("a", "b"))).alias(name) for c, name in ((False, "own"), (True, "copies"))]
        # Cut off, so that the join below stands alone and a segment that very many documents hold can be split.
        found = checkpointed(found.groupBy("anchor", "seg").agg(*parts).join(kinds.select("anchor", "seg", F.col("doc").alias("f_doc")), ["anchor", "seg"]))
        hits = some.join(found, ["anchor", "seg"])
        hits = hits.select("doc", "th", "start", F.explode(F.when(F.col("doc") > F.col("f_doc"), F.col("copies")).otherwise(F.col("own"))).alias("p"))
        out = checkpointed(hits.select("doc", "th", (F.col("start") + F.col("p.a")).alias("a"), (F.col("start") + F.col("p.b")).alias("b")))
        if texts:
            drop(texts)
        return out


def _kept(words: list[bytes], spans: list[dict]) -> tuple[bytes, int]:
    gone = np.zeros(len(words) + 1, np.int32)
    for s in spans:
        gone[s["a"]] += 1
        gone[s["b"]] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return b" ".join(w for w, k in zip(words, keep, strict=True) if k), int(len(words) - keep.sum())


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, texts: bool = False, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, and with texts=True kept_text (kept words joined by one space)."""
    p = Plain(docs)
    t = F.col(p[text])
    body = p.df.select(F.col(p[key]).cast("long").alias("doc"), F.xxhash64(F.coalesce(t, F.lit(""))).alias("th"), t.alias("text"))
    spans = repeated_intervals(body.where("doc is not null"), window, chunk)
    lists = spans.groupBy("doc", "th").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            n, gone, sha, kept = [], [], [], []
            for t, s in zip(x["text"], x["spans"], strict=True):
                words = split_words(t.as_py())
                k, g = _kept(words, s.as_py() or [])
                n.append(len(words))
                gone.append(g)
                sha.append(hashlib.sha256(k).hexdigest())
                kept.append(k.decode("utf-8", "surrogatepass") if texts else None)
            cols = [x["doc"], pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), *([pa.array(kept, pa.string())] if texts else [])]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_removed", "kept_sha256", *["kept_text"] * texts])

    # Documents that surely have no interval are not shuffled.
    some = bit_filter(spans.select(F.xxhash64("doc", "th").alias("key")).distinct()).holds(F.xxhash64("doc", "th"))
    none = body.where(~some | F.col("doc").isNull()).withColumn("spans", F.lit(None).cast("array<struct<a:int,b:int>>")).select("doc", "text", "spans")
    joined = body.where(some & F.col("doc").isNotNull()).join(lists, ["doc", "th"], "left").select("doc", "text", "spans")
    return none.union(joined).mapInArrow(run, schema)
