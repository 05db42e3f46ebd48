"""Toxicity by a convolutional text classifier trained in numpy.

Words are lower-cased runs of letters. A word's embedding is the sum of hashed rows for the word and its first four and five letters; filters of
several widths slide over the whole text, each filter's maximum goes through tanh and a logistic unit. Inference stores every word's
contribution to every filter once, so a text costs gathers and maxima only; long texts are walked in overlapping blocks.

Training uses a bounded sample (``max_fit_rows`` labelled rows, half of them positive, each of at most ``MAX_FIT_WORDS`` words and ``MAX_FIT_CHARS`` characters; longer rows are left
out of the fit only) of rows whose crc32(id as text) mod 3 is 0. All labelled rows with remainder 2, whole, calibrate a threshold for each language: they are scored
in Spark, and only counts by language, label and grid step reach the driver. Remainder 1 is held out. Labels, language, source and id are never inputs of a score.

Defined cases: a null or empty text is scored like any other (its filters see padding); a row without an id is scored and never learned from;
of rows that share an id the smallest text is learned from; columns named like a result, in whatever case, are replaced;
repeated labels of a document count as their maximum; without labels of both kinds every score is 0; repeated rows repeat; an empty table
gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Plain, settle

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 18, 8, 8, (1, 2, 3)
MAX_FIT_ROWS, MAX_FIT_WORDS, MAX_FIT_CHARS, EPOCHS, BLOCK, MEMO = 6000, 2000, 16_000, 4, 1 << 15, 1 << 17
LETTERS = re.compile(r"[^\W\d_]+")


def features(word: str) -> tuple[int, int, int]:
    """Rows of a lower-cased word: itself, and its first four and five letters (again itself where it is shorter)."""
    return tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS for x in ("w" + word, "4" + word[:4], "5" + word[:5]))


def words(text: str | None) -> list[str]:
    return LETTERS.findall((text or "").lower())


@dataclass
class Model:
    rows: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, DIM), np.float32))
    kernels: list[np.ndarray] = field(default_factory=list)  # for each width: width, DIM, FILTERS
    bias: np.ndarray = field(default_factory=lambda: np.zeros(FILTERS * len(WIDTHS), np.float32))
    out: np.ndarray = field(default_factory=lambda: np.zeros(FILTERS * len(WIDTHS) + 1, np.float32))
    trained: bool = False

    def table(self) -> np.ndarray:
        """DIM x all contributions: for each width and offset, FILTERS columns."""
        return np.concatenate([k[j] for k in self.kernels for j in range(len(k))], axis=1)

    def pooled(self, each: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maxima of the filters over one text's word contributions (n, columns), and where they are."""
        pad = max(WIDTHS) - 1
        each = np.concatenate([each, np.zeros((pad + (len(each) == 0), each.shape[1]), np.float32)])
        n, col, top, at = len(each) - pad, 0, [], []
        for w in WIDTHS:
            c = each[:n, col : col + FILTERS].copy()
            for j in range(1, w):
                c += each[j : n + j, col + j * FILTERS : col + (j + 1) * FILTERS]
            col += w * FILTERS
            p = c.argmax(axis=0)
            at.append(p)
            top.append(c[p, np.arange(FILTERS)])
        return np.concatenate(top), np.concatenate(at)

    def score(self, pooled: np.ndarray) -> float:
        z = float(np.tanh(pooled + self.bias) @ self.out[:-1] + self.out[-1])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30)))) if self.trained else 0.0


def encode(texts: list[str | None], most: int = MAX_FIT_WORDS) -> list[np.ndarray | None]:
    """Feature rows (words, 3) of each text; None for texts of more words. Strings are let go one text at a time."""
    memo: dict[str, tuple[int, int, int]] = {}
    out = []
    for t in texts:
        w = words(t)
        out.append(np.array([memo.get(x) or memo.setdefault(x, features(x)) for x in w], np.int32).reshape(-1, 3) if len(w) <= most else None)
        if len(memo) > MEMO // 4:
            memo.clear()
    return out


def train(ids: list[np.ndarray], labels: list[int], epochs: int = EPOCHS, seed: int = 7, rate: float = 0.1) -> Model:
    """Adagrad over single texts; gradients reach the words that a maximum came from."""
    rng = np.random.default_rng(seed)
    m, y = Model(), np.asarray(labels)
    if len(set(labels)) < 2:
        return m
    # The first dimension starts as the bucket's log odds by documents, the others as small noise.
    seen = np.zeros((2, BUCKETS), np.float32)
    for x, t in zip(ids, y, strict=True):
        seen[t, np.unique(x)] += 1
    odds = np.log((seen[1] + 0.5) / (y.sum() + 1)) - np.log((seen[0] + 0.5) / ((1 - y).sum() + 1))
    m.rows = rng.normal(0, 0.02, (BUCKETS, DIM)).astype(np.float32)
    m.rows[:, 0] = np.where(seen.sum(axis=0) >= 5, np.clip(odds, -3, 3), 0) / 3
    m.kernels = [rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for k in m.kernels:
        k[:, 0, :] += 0.7 / len(k)
    m.bias -= 1.0
    m.out[:-1] = 0.3
    m.trained = True
    cache = {"k": [np.full_like(k, 1e-2) for k in m.kernels], "b": np.full_like(m.bias, 1e-2), "o": np.full_like(m.out, 1e-2), "r": np.full(BUCKETS, 1e-2, np.float32)}

    def step(value: np.ndarray, grad: np.ndarray, c: np.ndarray) -> None:
        c += grad * grad
        value -= rate * grad / np.sqrt(c)

    for _ in range(epochs):
        for i in rng.permutation(len(ids)):
            x = ids[i]
            e = m.rows[x].sum(axis=1) if len(x) else np.zeros((0, DIM), np.float32)
            top, at = m.pooled(e @ m.table())
            h = np.tanh(top + m.bias)
            z = float(h @ m.out[:-1] + m.out[-1])
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]
            if abs(g) < 0.02:
                continue
            gh = (g * m.out[:-1] * (1 - h * h)).astype(np.float32)
            step(m.out, np.append(g * h, g).astype(np.float32), cache["o"])
            step(m.bias, gh, cache["b"])
            changed: dict[int, np.ndarray] = {}
            for a, (w, k) in enumerate(zip(WIDTHS, m.kernels, strict=True)):
                gk = np.zeros_like(k)
                for f in range(FILTERS):
                    for j in range(w):
                        t = at[a * FILTERS + f] + j
                        if t >= len(x):
                            continue
                        gk[j, :, f] += gh[a * FILTERS + f] * e[t]
                        for r in x[t]:
                            changed[r] = changed.get(r, 0) + gh[a * FILTERS + f] * k[j, :, f]
                step(k, gk, cache["k"][a])
            for r, gr in changed.items():
                cache["r"][r] += float(gr @ gr)
                m.rows[r] -= rate * gr / np.sqrt(cache["r"][r])
    return m


class Scorer:
    """Scores texts with each word's contributions computed once."""

    def __init__(self, model: Model):
        self.model, self.columns = model, model.table() if model.trained else np.zeros((DIM, 1), np.float32)
        self.at: dict[str, int] = {}
        self.store = np.zeros((1 << 12, self.columns.shape[1]), np.float32)

    def index(self, word: str) -> int:
        i = self.at[word] = len(self.at)
        if i >= len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.store[i] = self.model.rows[list(features(word))].sum(axis=0) @ self.columns
        return i

    def score(self, text: str | None) -> float:
        if not self.model.trained:
            return 0.0
        if len(self.at) > MEMO:
            self.at.clear()
        w, over, top = words(text), max(WIDTHS) - 1, None
        for k in range(0, max(len(w), 1), BLOCK):
            part = w[k : k + BLOCK + over]
            get, add = self.at.get, self.index
            ids = [i if (i := get(x)) is not None else add(x) for x in part]
            p, _ = self.model.pooled(self.store[ids])
            top = p if top is None else np.maximum(top, p)
        return self.model.score(top)


GRID = np.linspace(0.3, 0.7, 9)  # ascending; the last is the default


def best_threshold(counts: np.ndarray) -> float:
    """The threshold with the highest F1, the highest of equals; the default where there is too little to tell. counts: by label, and by how many thresholds a score reaches."""
    if min(counts.sum(axis=1)) < 5:
        return float(GRID[-1])
    clean, hits = counts[:, ::-1].cumsum(axis=1)[:, :-1]  # from the highest threshold down
    f1 = 2 * hits / np.maximum(1, clean + hits + counts[1].sum())
    return float(GRID[::-1][int(np.argmax(f1))])


def fold(key: str):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3


def _slim(docs: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """id, text and lang (null without such a column) of a table with whatever other columns."""
    p = Plain(docs)
    lang = p.find(lang)
    return p.df.select(F.col(p[key]).alias("id"), F.col(p[text]).alias("text"), (F.col(lang) if lang else F.lit(None)).cast("string").alias("lang"))


def _labelled(labels: DataFrame, key: str, label: str, remainder: int) -> DataFrame:
    """id and y, its label, of a fold."""
    p = Plain(labels)
    own = p.df.select(F.col(p[key]).alias("id"), F.col(p[label]).alias("y"))
    return own.groupBy("id").agg(F.max("y").cast("int").alias("y")).where((fold("id") == remainder) & F.col("y").isin(0, 1))


def _sample(docs: DataFrame, labelled: DataFrame, rows: int) -> list:
    """At most rows labelled documents, half of each label, by hash order of the id."""
    few = [labelled.where(F.col("y") == y).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(rows // 2) for y in (0, 1)]
    picked = docs.join(F.broadcast(few[0].union(few[1])), "id")  # at most `rows` rows
    picked = picked.where(F.length(F.coalesce("text", F.lit(""))) <= MAX_FIT_CHARS)
    got = picked.groupBy("id", "y").agg(F.min("text").alias("text")).collect()  # of rows with one id the smallest text
    return sorted(got, key=lambda r: (zlib.crc32(str(r["id"]).encode()), r["id"]))


def _counts(docs: DataFrame, labelled: DataFrame, model: Model) -> dict[str, np.ndarray]:
    """For each language ('' without one) best_threshold's counts over all labelled rows of the calibration fold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS * DIM floats
    scorer: list[Scorer] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not scorer:
            scorer.append(Scorer(shared.value))
        for x in batches:
            step = np.searchsorted(GRID, [scorer[0].score(t.as_py()) for t in x["text"]], side="right")
            yield pa.RecordBatch.from_arrays([x["lang"], x["y"], pa.array(step.astype(np.int32))], ["lang", "y", "step"])

    rows = docs.join(labelled, "id").select(F.coalesce("lang", F.lit("")).alias("lang"), "y", "text")
    out: dict[str, np.ndarray] = {}
    for lang, y, step, n in rows.mapInArrow(run, "lang string, y int, step int").groupBy("lang", "y", "step").count().collect():
        out.setdefault(lang, np.zeros((2, len(GRID) + 1), np.int64))[y, step] = n
    shared.unpersist()
    return out


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_fit_rows: int = MAX_FIT_ROWS, lang: str = "lang", label_key: str | None = None) -> tuple[Model, dict[str, float]]:
    """The model, and thresholds by language ('' for the rest)."""
    slim, label_key = _slim(docs, key, text, lang), label_key or key
    got = _sample(slim, _labelled(labels, label_key, label, 0), max_fit_rows)
    pairs = [(x, r["y"]) for x, r in zip(encode([r["text"] for r in got]), got, strict=True) if x is not None]
    del got
    settle(docs.sparkSession)
    model = train([x for x, _ in pairs], [y for _, y in pairs])
    del pairs
    counts = _counts(slim, _labelled(labels, label_key, label, 2), model) if model.trained else {}
    cut = {"": best_threshold(sum(counts.values(), np.zeros((2, len(GRID) + 1), np.int64)))}
    cut |= {g: best_threshold(c) for g, c in sorted(counts.items()) if g}
    return model, cut


def score_table(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_fit_rows: int = MAX_FIT_ROWS, lang: str = "lang", label_key: str | None = None) -> DataFrame:
    """docs' columns with held_out, score, predicted (score >= 0.7) and rejected (score at the language's threshold or above)."""
    model, cut = fit(docs, labels, key, text, label, max_fit_rows, lang, label_key)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS * DIM floats
    scorer: list[Scorer] = []
    p = Plain(docs)
    body, lang = p[text], p.find(lang)
    schema = T.StructType([*p.df.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not scorer:
            scorer.append(Scorer(shared.value))
        for x in batches:
            s = [scorer[0].score(t.as_py()) for t in x[body]]
            yield pa.RecordBatch.from_arrays([*x.columns, pa.array(s, pa.float64())], [*x.schema.names, "score"])

    threshold = F.lit(cut[""])
    if lang:
        for g, t in cut.items():
            if g:
                threshold = F.when(F.col(lang) == g, t).otherwise(threshold)
    out = p.df.mapInArrow(run, schema).withColumns({"held_out": F.coalesce(fold(p[key]) == 1, F.lit(False)), "predicted": (F.col("score") >= 0.7).cast("int"), "rejected": F.col("score") >= threshold})
    return p.back(out, "held_out", "score", "predicted", "rejected")
