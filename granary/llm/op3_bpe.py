"""Byte-level BPE encoding and decoding.

Pre-tokens that are vocabulary entries are resolved by a minimal perfect hash: one displacement for each bucket of keys sends every entry to a slot of
its own, and the slot's bytes confirm the match. Misses are merged by a heap over linked bytes: the heap holds adjacent pairs by rank and
place, links skip merged bytes, so a pre-token of n bytes takes O(n log n) whatever its length. A bounded memo in front of both keeps the pieces of
frequent pre-tokens.

The vocabulary's path is a parameter; the driver reads it and broadcasts the tables, whose size the vocabulary bounds.

Defined cases: null text counts as empty (no ids, empty bytes); any Unicode text round-trips; rows repeat as in the input; an empty table gives
no rows; only id and text are read, so other columns' names do not matter.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import Plain

MASK = (1 << 64) - 1
MEMO = 1 << 19


@dataclass
class PerfectHash:
    """Minimal perfect hash of byte strings to their ids: displacement by bucket, then as many slots as keys."""

    displaced: list[int]
    keys: list[bytes]
    ids: list[int]

    @staticmethod
    def slot(h: int, d: int, n: int) -> int:
        if d < 0:  # a bucket of one key names its slot
            return -d - 1
        return ((((h ^ (d * 0x9E3779B97F4A7C15 & MASK)) * 0xD6E8FEB86659FD93 & MASK) >> 32) * n) >> 32

    @classmethod
    def build(cls, entries: dict[bytes, int], load: int = 4) -> PerfectHash:
        n = len(entries)
        width = max(1, n // load)
        buckets: list[list[tuple[int, bytes]]] = [[] for _ in range(width)]
        for k in entries:
            h = xxh64_intdigest(k)
            buckets[h % width].append((h, k))
        displaced, keys, ids = [0] * width, [b""] * n, [-1] * n
        free = bytearray(b"\x01") * n
        spare = 0
        for b in sorted(range(width), key=lambda b: -len(buckets[b])):
            group = buckets[b]
            if len(group) == 1:
                while not free[spare]:
                    spare += 1
                d, at = -spare - 1, [spare]
            else:
                d = 0
                while True:
                    at = [cls.slot(h, d, n) for h, _ in group]
                    if len(set(at)) == len(at) and all(free[s] for s in at):
                        break
                    d += 1
            displaced[b] = d
            for s, (_, k) in zip(at, group, strict=True):
                free[s], keys[s], ids[s] = 0, k, entries[k]
        return cls(displaced, keys, ids)

    def get(self, key: bytes) -> int:
        """The id, or -1."""
        h = xxh64_intdigest(key)
        s = self.slot(h, self.displaced[h % len(self.displaced)], len(self.keys))
        return self.ids[s] if self.keys[s] == key else -1


@dataclass
class Vocabulary:
    words: list[bytes | None]
    whole: PerfectHash
    pairs: dict[int, int]
    single: list[int]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """A file of base64 bytes and rank on each line."""
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        return cls.of(ranks)

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> Vocabulary:
        words: list[bytes | None] = [None] * (max(ranks.values()) + 1)
        pairs = {}
        for w, r in ranks.items():
            words[r] = w
            for i in range(1, len(w)):
                a, b = ranks.get(w[:i]), ranks.get(w[i:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = r
        return cls(words, PerfectHash.build(ranks), pairs, [ranks[bytes([i])] for i in range(256)])

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of a pre-token that is no entry."""
        n = len(piece)
        ids, nxt, prv = [self.single[c] for c in piece], list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.pairs.get
        rank = [get(a << 32 | b, -1) for a, b in zip(ids, ids[1:], strict=False)] + [-1]
        heap = [r << 32 | i for i, r in enumerate(rank) if r >= 0]
        heapify(heap)
        while heap:
            x = heappop(heap)
            i, r = x & 0xFFFFFFFF, x >> 32
            if rank[i] != r:
                continue
            j = nxt[i]
            k = nxt[j]
            ids[i], nxt[i], rank[j], ids[j] = r, k, -1, -1
            rank[i] = -1
            if k < n:
                prv[k] = i
                if (q := get(r << 32 | ids[k], -1)) >= 0:
                    rank[i] = q
                    heappush(heap, q << 32 | i)
            if (p := prv[i]) >= 0:
                rank[p] = q = get(ids[p] << 32 | r, -1)
                if q >= 0:
                    heappush(heap, q << 32 | p)
        return tuple(x for x in ids if x >= 0)


class Encoder(dict):
    """Pre-token to ids; a dict that computes what it lacks and starts anew when it is full."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, room: int = MEMO):
        import regex

        super().__init__()
        self.vocabulary, self.room = vocabulary, room
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall

    def __missing__(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode("utf-8")
        i = self.vocabulary.whole.get(raw)
        ids = (i,) if i >= 0 else self.vocabulary.merge(raw)
        if len(self) >= self.room:
            self.clear()
        if len(raw) <= 64:
            self[piece] = ids
        return ids

    def encode(self, text: str) -> array:
        return array("I", chain.from_iterable(map(self.__getitem__, self.split(text))))

    def decode(self, ids: array) -> bytes:
        return b"".join(map(self.vocabulary.words.__getitem__, ids))


def _little(ids: array) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def _encoders(docs: DataFrame, vocabulary: Vocabulary, pattern: str):
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, pattern))
    own: list[Encoder] = []

    def encoder() -> Encoder:
        if not own:
            own.append(Encoder(*shared.value))
        return own[0]

    return encoder


def encode_table(docs: DataFrame, vocabulary: Vocabulary, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and token_ids of each text."""
    encoder = _encoders(docs, vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder()
        for x in batches:
            ids = pa.array([np.asarray(e.encode(t.as_py() or ""), np.int32) for t in x["text"]], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([x["doc_id"], ids], ["doc_id", "token_ids"])

    p = Plain(docs)
    return p.df.select(F.col(p[key]).cast("long").alias("doc_id"), F.col(p[text]).alias("text")).mapInArrow(run, "doc_id long, token_ids array<int>")


def decode_table(rows: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", ids: str = "token_ids") -> DataFrame:
    """doc_id and the decoded bytes (UTF-8 of the text that was encoded)."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for x in batches:
            data = [b"".join(words[i] for i in r.as_py() or ()) for r in x["ids"]]
            yield pa.RecordBatch.from_arrays([x["doc_id"], pa.array(data, pa.binary())], ["doc_id", "data"])

    return rows.select(F.col(key).cast("long").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(run, "doc_id long, data binary")


def encode_digests(docs: DataFrame, vocabulary: Vocabulary, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes and decodes each text without moving the ids."""
    encoder = _encoders(docs, vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder()
        for x in batches:
            n, i, d = [], [], []
            for t in x["text"]:
                ids = e.encode(t.as_py() or "")
                n.append(len(ids))
                i.append(hashlib.sha256(_little(ids)).hexdigest())
                d.append(hashlib.sha256(e.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([x["doc_id"], pa.array(n, pa.int64()), pa.array(i, pa.string()), pa.array(d, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    p = Plain(docs)
    slim = p.df.select(F.col(p[key]).cast("long").alias("doc_id"), F.col(p[text]).alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
