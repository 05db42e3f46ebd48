"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample (``fit_rows`` vectors, by hash order) with ``branching`` children a node down to about ``leaves`` leaves (one for 1024 rows, 4096 at most); every
row is then put into its leaf. A query walks the tree best-bin-first: a priority queue holds the branches not taken by how near their centres are, and
the best is opened next, until ``visits`` leaves are reached. Visits are calibrated: a sample of ``CALIBRATE`` queries is answered exactly (in blocks, each
with a running top list), and visits widen from one leaf on until the wanted share of their true neighbours lies in leaves that they reach; all leaves is exact.

Leaves are dealt in tiles: a leaf of many vectors is cut into chunks of at most about ``tile`` rows by hash of the id, and so are the queries that visit it; each
(vectors, queries) tile is one group, scores are double precision and each tile keeps k a query, so no group grows with a leaf and no pair leaves a tile
that cannot be among the k nearest found. Ties go to the smaller id.

Defined cases: null vectors, zero vectors and those holding null or non-finite components, or of another length than most, take no part, nor do rows without an
id; repeated ids are separate candidates (a query skips rows with its own id and is answered once, by the smallest of its vectors in their order as arrays); fewer candidates than k: all of them; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import checkpointed, drop, materialize

FIT_ROWS, BRANCHING, TILE, CALIBRATE, MAX_LEAVES = 20_000, 8, 4096, 64, 4096


@dataclass
class Node:
    centre: np.ndarray
    children: list[Node]
    leaf: int = -1

    def __post_init__(self) -> None:
        self.centres = np.stack([n.centre for n in self.children]) if self.children else None


@dataclass
class Tree:
    root: Node
    leaves: int

    def order(self, q: np.ndarray, visits: int) -> list[int]:
        """Leaves of the best-bin-first walk."""
        out: list[int] = []
        queue, tick = [(0.0, 0, self.root)], 0
        while queue and len(out) < visits:
            _, _, node = heapq.heappop(queue)
            while node.leaf < 0:
                near = node.centres @ q
                best = int(near.argmax())
                for i, child in enumerate(node.children):
                    if i != best:
                        tick += 1
                        heapq.heappush(queue, (-float(near[i]), tick, child))
                node = node.children[best]
            out.append(node.leaf)
        return out

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Each row's leaf."""
        out = np.empty(len(x), np.int32)
        stack = [(self.root, np.arange(len(x)))]
        while stack:
            node, at = stack.pop()
            if node.leaf >= 0:
                out[at] = node.leaf
                continue
            c = node.centres
            best = (x[at] @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
            stack += [(n, at[best == i]) for i, n in enumerate(node.children) if (best == i).any()]
        return out


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
        c = np.stack([x[own == i].mean(axis=0) if (own == i).any() else c[i] for i in range(k)])
    return c, (x @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)


def fit_tree(x: np.ndarray, leaves: int, branching: int = BRANCHING, seed: int = 5) -> Tree:
    rng, count = np.random.default_rng(seed), 0
    least = max(2 * branching, -(-len(x) // max(1, leaves)))

    def grow(part: np.ndarray, depth: int) -> Node:
        nonlocal count
        centre = part.mean(axis=0)
        if len(part) > least and depth < 12 and (part != part[0]).any():
            c, own = _kmeans(part, branching, rng)
            kids = [i for i in range(branching) if (own == i).any()]
            if len(kids) > 1:
                return Node(centre, [grow(part[own == i], depth + 1) for i in kids])
        count += 1
        return Node(centre, [], count - 1)

    return Tree(grow(x, 0), count)


def _matrix(s: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in s]) if len(s) else np.zeros((0, 1))


def usable(v: Column) -> Column:
    """Has no null or non-finite component, and one that is not zero."""
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda c: c != 0)


def _top(q_ids: np.ndarray, q: np.ndarray, v_ids: np.ndarray, v: np.ndarray, k: int) -> pd.DataFrame:
    """The k best of v for each q without its own id; ties to the smaller id.

    A matrix product makes the shortlist, wide enough for its rounding; the shortlist is then scored component by component.
    """
    parts = []
    slack = 1e-12 * q.shape[1] * np.linalg.norm(q, axis=1) * (np.linalg.norm(v, axis=1).max() if len(v) else 0)
    for i in range(0, len(q), 256):
        s = q[i : i + 256] @ v.T
        s[q_ids[i : i + 256, None] == v_ids[None, :]] = -np.inf
        if len(v_ids) > k:
            cut = np.partition(s, len(v_ids) - k, axis=1)[:, len(v_ids) - k] - slack[i : i + 256]
            a, b = np.nonzero((s >= cut[:, None]) & (s > -np.inf))
        else:
            a, b = np.nonzero(s > -np.inf)
        exact = exact_products(q[i + a], v[b])
        at = np.lexsort((v_ids[b], -exact, a))
        a, b, exact = a[at], b[at], exact[at]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        keep = rank < k
        parts.append(pd.DataFrame({"query_id": q_ids[i + a[keep]], "vec_id": v_ids[b[keep]], "score": exact[keep]}))
    return pd.concat(parts) if parts else pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})


def exact_products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed component by component in double precision: the same bits for equal vectors whatever the tile."""
    out = np.zeros(len(q))
    for d in range(q.shape[1]):
        out += q[:, d] * v[:, d]
    return out


_TOP = "query_id long, vec_id long, score double"


def _best(found: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact_search(queries: pd.DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """All rows in blocks against a bounded set of queries (id, vec); each block keeps k a query."""
    shared = vectors.sparkSession.sparkContext.broadcast((queries["id"].to_numpy(np.int64), _matrix(queries["vec"])))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, q = shared.value
        for x in batches:
            for i in range(0, len(x), TILE):
                p = x.iloc[i : i + TILE]
                yield _top(ids, q, p["id"].to_numpy(np.int64), _matrix(p["vec"]), k)

    return _best(vectors.select("id", "vec").mapInPandas(run, _TOP), k)


def search_tree(tree: Tree, queries: DataFrame, indexed: DataFrame, k: int, visits: int) -> DataFrame:
    """k nearest found of each query (id, vec) in its first ``visits`` leaves of indexed (id, vec, leaf)."""
    shared = indexed.sparkSession.sparkContext.broadcast(tree)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = shared.value
        for x in batches:
            yield pd.DataFrame({"id": x["id"], "vec": x["vec"], "leaf": [np.asarray(t.order(np.asarray(v, np.float64), visits), np.int32) for v in x["vec"]]})

    asked = queries.select("id", "vec").mapInPandas(walk, "id long, vec array<double>, leaf array<int>").select("id", "vec", F.explode("leaf").alias("leaf"))
    # Chunks by leaf: at most as many rows as the tree has leaves.
    size = indexed.groupBy("leaf").agg(F.count("*").alias("n")).join(asked.groupBy("leaf").agg(F.count("*").alias("m")), "leaf")
    size = size.select("leaf", F.ceil(F.col("n") / TILE).cast("int").alias("cv"), F.ceil(F.col("m") / TILE).cast("int").alias("cq"))
    v = indexed.join(F.broadcast(size), "leaf")
    v = v.select("leaf", F.pmod(F.xxhash64("id"), "cv").cast("int").alias("tv"), F.explode(F.sequence(F.lit(0), F.col("cq") - 1)).alias("tq"), "id", "vec", F.lit(False).alias("ask"))
    q = asked.join(F.broadcast(size), "leaf")
    q = q.select("leaf", F.explode(F.sequence(F.lit(0), F.col("cv") - 1)).alias("tv"), F.pmod(F.xxhash64("id"), "cq").cast("int").alias("tq"), "id", "vec", F.lit(True).alias("ask"))

    def tile(x: pd.DataFrame) -> pd.DataFrame:
        a, b = x[x["ask"]], x[~x["ask"]]
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        return _top(a["id"].to_numpy(np.int64), _matrix(a["vec"]), b["id"].to_numpy(np.int64), _matrix(b["vec"]), k)

    return _best(v.unionByName(q).groupBy("leaf", "tv", "tq").applyInPandas(tile, _TOP), k)


def needed_visits(places: list[int], recall: float) -> int:
    """The fewest leaves that reach the recall; places: where in its query's walk the leaf of each true neighbour stands."""
    ordered = sorted(places)
    return 1 + (ordered[min(len(ordered), int(np.ceil(recall * len(ordered)))) - 1] if ordered else 0)


def nearest(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20, recall: float = 0.96, fit_rows: int = FIT_ROWS, leaves: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found by largest inner product."""
    v = F.col(vector).cast("array<double>")
    base = vectors.select(F.col(key).cast("long").alias("id"), v.alias("vec"), F.coalesce(is_query, F.lit(False)).alias("ask")).where(F.col("id").isNotNull() & usable(F.col("vec")))
    kept = base = materialize(base)
    spark = base.sparkSession
    wide = base.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if wide is None:
        return empty
    base = base.where(F.size("vec") == wide["d"])
    n = wide["n"]
    leaves = leaves or int(min(MAX_LEAVES, max(8, n // 1024)))
    fit = base.orderBy(F.xxhash64("id"), "id").limit(fit_rows).select("vec").toPandas()
    tree = fit_tree(_matrix(fit["vec"]), leaves)
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            yield pd.DataFrame({"id": x["id"], "vec": x["vec"], "leaf": shared.value.assign(_matrix(x["vec"])) if len(x) else np.zeros(0, np.int32)})

    indexed = materialize(base.select("id", "vec").mapInPandas(place, "id long, vec array<double>, leaf int"))
    asked = materialize(base.where("ask").groupBy("id").agg(F.min("vec").alias("vec")))
    known = asked.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(CALIBRATE).toPandas()
    if not len(known):
        return empty
    truth = exact_search(known, indexed, k).join(indexed.select(F.col("id").alias("vec_id"), "leaf"), "vec_id").select("query_id", "vec_id", "leaf").distinct().toPandas()
    walks = {i: {leaf: at for at, leaf in enumerate(tree.order(np.asarray(x, np.float64), tree.leaves))} for i, x in zip(known["id"], known["vec"], strict=True)}
    visits = needed_visits([walks[i][leaf] for i, leaf in zip(truth["query_id"], truth["leaf"], strict=True)], recall)
    out = checkpointed(search_tree(tree, asked, indexed, k, visits))
    for t in (asked, indexed, kept):
        drop(t)
    return out
