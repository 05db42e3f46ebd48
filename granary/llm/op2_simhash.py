"""SimHash near-duplicates by segment-popcount embedding.

A fingerprint's 64 bits form 32 segments of two bits; the vector of segment popcounts embeds it in a grid, where the Manhattan distance is at
most the Hamming distance. If two fingerprints differ in at most 5 bits, one of their halves (16 segments) is at Manhattan distance 2 or
less, so some cell lies within 1 of both; for up to 8 bits the same holds of thirds. Each fingerprint is therefore put into the cells within 1 of its bands'
vectors (50 on average), fingerprints that meet in a cell are candidates, and the Hamming distance decides: no link is lost.

Equal fingerprints are one node, so copies never pair up. Members of a cell arrive sorted; up to ``SMALL`` are compared pair by pair, larger cells
by a search that compares each reached member with those not yet reached, which gives edges that span the same groups in time
linear in a group of near copies. Cells of over ``CROWD`` members are first cut into groups that agree in one of limit + 1 runs of bits,
so that members far apart are not compared. Components come from graph.components.

Defined cases: a null text has no words; no words: fingerprint 0, linked like any other; under four words: one shingle, the whole sequence;
repeated rows and ids share fingerprint and component; a row without an id takes part with its fingerprint and gets the component
of the ids it is linked to through an equal fingerprint, null without any; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Plain, checkpointed, drop, materialize
from .graph import components

SHINGLE, SEED, BLOCK, SMALL, CROWD = 4, 42, 1 << 15, 48, 2048


def bit_sums(h: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def majority(ones: np.ndarray, n: int) -> int:
    """The fingerprint: bits set in over half of n hashes."""
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a whole text."""
    from xxhash import xxh64_intdigest as digest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
    n = max(1, len(words) - size + 1)
    a, b = starts[:n].tolist(), (ends[-n:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, n, BLOCK):
        h = np.fromiter((digest(body[i:j], SEED) for i, j in zip(a[k : k + BLOCK], b[k : k + BLOCK], strict=True)), np.uint64, min(BLOCK, n - k))
        ones += bit_sums(h)
    return majority(ones, n)


def segment_counts(fps: np.ndarray) -> np.ndarray:
    """Each pair of bits replaced by its popcount."""
    return fps - ((fps >> np.uint64(1)) & np.uint64(0x5555555555555555))


def _bands(count: int) -> list[tuple[int, int]]:
    """First bit and width of each band of segments."""
    cuts = [2 * (32 * i // count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _band(v: np.ndarray, first: int, width: int) -> np.ndarray:
    return (v >> np.uint64(first)) & np.uint64((1 << width) - 1)


def _manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros(len(a), np.int64)
    for i in range(0, 32, 2):
        out += np.abs(((a >> np.uint64(i)) & np.uint64(3)).astype(np.int64) - ((b >> np.uint64(i)) & np.uint64(3)).astype(np.int64))
    return out


def cells(fps: np.ndarray, bands: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the cells within 1 of each band's vector, and the fingerprint of each."""
    keys, owners, counts = [], [], segment_counts(fps)
    for k, (first, width) in enumerate(_bands(bands)):
        v, top = _band(counts, first, width), np.uint64(k << 32)
        keys.append(v | top)
        owners.append(fps)
        for i in range(0, width, 2):
            c = (v >> np.uint64(i)) & np.uint64(3)
            one = np.uint64(1 << i)
            keys += [(v[c < 2] + one) | top, (v[c > 0] - one) | top]
            owners += [fps[c < 2], fps[c > 0]]
    return np.concatenate(keys), np.concatenate(owners)


def _spanning(f: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Edges that connect what is connected within limit among f."""
    left, out = f, []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            a = queue.pop()
            near = np.bitwise_count(left ^ a) <= limit
            out += [(int(a), int(b)) for b in left[near]]
            queue += list(left[near])
            left = left[~near]
    return out


def _blocks(f: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Groups of f that agree in one of limit + 1 runs of bits: fingerprints that differ in at most limit bits share one."""
    cuts = [64 * i // (limit + 1) for i in range(limit + 2)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        own = _band(f, a, b - a)
        order = np.argsort(own, kind="stable")
        for part in np.split(f[order], np.flatnonzero(np.diff(own[order])) + 1):
            if len(part) > 1:
                yield part


def links_in_cells(keys: np.ndarray, fps: np.ndarray, limit: int, bands: int) -> np.ndarray:
    """Pairs (n, 2) of linked fingerprints; keys are sorted."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, len(keys)])
    found: list[np.ndarray] = []
    size_of = np.repeat(sizes, sizes)
    at = np.flatnonzero((size_of > 1) & (size_of <= SMALL))
    for d in range(1, SMALL):
        at = at[at + d < len(keys)]
        at = at[keys[at] == keys[at + d]]
        if not len(at):
            break
        a, b, k = fps[at], fps[at + d], keys[at]
        near = np.bitwise_count(a ^ b) <= limit
        a, b, k = a[near], b[near], k[near]
        # A pair shares several cells: of those, the one that is the smaller vector, if it is one of both, reports it.
        ca, cb, va, vb = segment_counts(a), segment_counts(b), np.zeros_like(a), np.zeros_like(b)
        for i, (first_bit, width) in enumerate(_bands(bands)):
            here = (k >> np.uint64(32)) == i
            va[here], vb[here] = _band(ca[here], first_bit, width), _band(cb[here], first_bit, width)
        own = (_manhattan(va, vb) > 1) | ((k & np.uint64(0xFFFFFFFF)) == np.minimum(va, vb))
        found.append(np.stack([a[own], b[own]], axis=1))
    for i, n in zip(first[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        for part in _blocks(fps[i : i + n], limit) if n > CROWD else [fps[i : i + n]]:
            if pairs := _spanning(part, limit):
                found.append(np.array(pairs, np.uint64))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.uint64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in x["text"]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([x["doc_id"], pa.array(fp)], ["doc_id", "fp"])

    p = Plain(docs)
    slim = p.df.select(F.col(p[key]).cast("long").alias("doc_id"), F.col(p[text]).alias("text"))
    return slim.mapInArrow(run, "doc_id long, fp long")


def near_links(fps: DataFrame, limit: int = 4) -> DataFrame:
    """Links a, b between distinct fingerprints (column fp) at limit or fewer differing bits; spanning in crowded cells."""
    if not 0 <= limit <= 8:
        raise ValueError("the grid's radius answers for up to 8 bits")
    bands = 2 if limit <= 5 else 3

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            all_ = x["fp"].to_numpy(np.int64).view(np.uint64)
            for i in range(0, len(all_), 4096):
                k, f = cells(all_[i : i + 4096], bands)
                yield pd.DataFrame({"cell": k.view(np.int64), "fp": f.view(np.int64)})

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for x in batches:
            k, f = x["cell"].to_numpy(np.int64).view(np.uint64), x["fp"].to_numpy(np.int64).view(np.uint64)
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1]))  # the last cell may go on
            if cut == 0:
                held.append((k, f))
                continue
            held.append((k[:cut], f[:cut]))
            held_k, held_f = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            e = links_in_cells(held_k, held_f, limit, bands).view(np.int64)
            yield pd.DataFrame({"a": e[:, 0], "b": e[:, 1]})
            held = [(k[cut:], f[cut:])]
        if held:
            held_k, held_f = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            e = links_in_cells(held_k, held_f, limit, bands).view(np.int64)
            yield pd.DataFrame({"a": e[:, 0], "b": e[:, 1]})

    in_cells = fps.select("fp").mapInPandas(spread, "cell long, fp long")
    return in_cells.repartition("cell").sortWithinPartitions("cell").mapInPandas(verify, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 4, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest id that links reach."""
    own = materialize(fingerprints(docs, key, text, shingle))
    nodes = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("node")))
    links = near_links(nodes, limit)
    named = links.join(nodes.select(F.col("fp").alias("a"), F.col("node").alias("u")), "a").join(nodes.select(F.col("fp").alias("b"), F.col("node").alias("v")), "b")
    groups = components(named.where("u is not null and v is not null").select("u", "v"))
    labelled = nodes.join(groups, "node", "left").select("fp", F.coalesce("label", "node").alias("component_id"))
    out = checkpointed(own.join(labelled, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
    drop(nodes)
    drop(own)
    return out
