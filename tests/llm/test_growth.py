"""What must not grow with the square of the rows: candidates of joins and what groups make."""

from functools import reduce

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import common, near_copies, op6_substrings, op10_lines
from tests.llm.test_llm import removed_windows


def test_long_unlike_lines_are_no_candidates(spark):
    """Long lines that share some words pass no filter; near ones, also of a short and a long set, do."""
    rng = np.random.default_rng(3)
    lines = [" ".join(f"w{x}" for x in rng.choice(900, 60 + 4 * (i % 40), replace=False)) for i in range(120)]
    near = [(i, 120 + i) for i in range(0, 120, 5)]
    lines += [" ".join(lines[i].split()[: -len(lines[i].split()) // 12]) for i, _ in near]
    near = [(i, 120 + k) for k, (i, _) in enumerate(near)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc long, text string").withColumn("th", F.xxhash64("text"))
    whole = op10_lines.line_sets(docs, op10_lines.rarity_classes(docs), 4, 5)
    sets = whole.withColumn("first", F.struct(*op10_lines.PLACE)).cache()
    pairs = reduce(DataFrame.union, [op10_lines._joined(sets, sets, 4, 5, part) for part in range(op10_lines.PARTS)]).distinct()
    doc = {r["set"]: r["doc"] for r in sets.collect()}
    got = {tuple(sorted((doc[r["set"]], doc[r["o_set"]]))) for r in pairs.collect()}
    assert set(near) <= got and len(got) <= len(near) + 10


def test_near_copies_come_from_fingerprints_first(spark):
    """Near copies of close fingerprints are candidates of the SimHash grid, whatever their min-hashes; parities let no true pair go and drop unlike ones."""
    rng = np.random.default_rng(5)
    texts = [[f"v{x}" for x in rng.integers(0, 10**6, 400)] for _ in range(40)]
    texts += [[*t[:200], "other", *t[201:]] for t in texts]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = near_copies.shingle_sets(docs, "doc_id", "text", 5).cache()
    name = {r["set"]: r["key"] for r in sets.collect()}
    got = {tuple(sorted((name[r["a"]], name[r["b"]]))) for r in near_copies._fingerprint_pairs(sets).collect()}
    own = [near_copies.shingle_set(" ".join(t), 5) for t in texts]
    bits = [near_copies.fingerprint_of(s) for s in own]
    near = {(i, 40 + i) for i in range(40) if (bits[i] ^ bits[40 + i]).bit_count() <= near_copies.FP_BITS}
    assert len(near) > 20 and near <= got
    every = sets.alias("x").join(sets.alias("y"), F.col("x.set") < F.col("y.set")).select(F.col("x.set").alias("a"), F.col("y.set").alias("b"))
    assert {tuple(sorted((name[r["a"]], name[r["b"]]))) for r in near_copies._reach(every, sets, 4, 5).collect()} == {(i, 40 + i) for i in range(40)}
    for i in range(40):
        for j in (i + 40, (i + 1) % 40):
            differ = near_copies.apart(near_copies.parities(own[i]), near_copies.parities(own[j]))
            true = len(np.setxor1d(own[i], own[j]))
            assert differ <= true and (true < 20 or differ > 200)
    assert near_copies.apart(near_copies.parities(own[0]), near_copies.parities(own[0][:100])) <= len(own[0]) - 100
    assert near_copies.parities(own[0][:0]) == bytes(32)


def test_settle_returns_native_memory(spark):
    """What threads of finished queries have freed goes back to the system: resident memory falls by what malloc held."""
    allocate = spark.sparkContext._jvm.org.apache.spark.unsafe.Platform
    pid = spark.sparkContext._jvm.java.lang.ProcessHandle.current().pid()
    resident = lambda: int(next(x for x in open(f"/proc/{pid}/status") if x.startswith("VmRSS")).split()[1]) // 1024
    held = [allocate.allocateMemory(64 << 10) for _ in range(3000)]
    for at in held:
        allocate.setMemory(at, 1, 64 << 10)
    fence = allocate.allocateMemory(64 << 10)  # what lies below it stays with malloc when freed
    for at in held:
        allocate.freeMemory(at)
    before = resident()
    assert common.trim_native(spark)
    assert resident() < before - 100
    allocate.freeMemory(fence)


def test_crowds_of_lines_pair_with_earlier_ones_only(spark):
    """A crowd's candidates are each pair once, later line first, and only lines that no leader has proven look for partners; results are those of brute force."""
    rng = np.random.default_rng(11)
    base = [f"b{x}" for x in range(40)]
    lines = [" ".join([*(w for k, w in enumerate(base) if k not in set(rng.choice(40, 4, replace=False))), f"own{i}"]) for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc long, text string").withColumn("th", F.xxhash64("text"))
    whole = op10_lines.line_sets(docs, op10_lines.rarity_classes(docs), 4, 5)
    sets = whole.withColumn("first", F.struct(*op10_lines.PLACE)).cache()
    doc = {r["set"]: r["doc"] for r in sets.collect()}
    toks = [set(x.split()) for x in lines]
    near = {(j, i) for i in range(120) for j in range(i + 1, 120) if 5 * len(toks[i] & toks[j]) >= 4 * len(toks[i] | toks[j])}
    none = sets.limit(0)
    got = {(doc[r["set"]], doc[r["o_set"]]) for part in range(op10_lines.PARTS) for r in op10_lines._joined(sets, none, 4, 5, part).collect()}
    assert near <= got and all(a > b for a, b in got)
    late = sets.where("doc >= 100")
    got = {(doc[r["set"]], doc[r["o_set"]]) for part in range(op10_lines.PARTS) for r in op10_lines._joined(late, sets.where("doc < 100"), 4, 5, part).collect()}
    assert {p for p in near if p[0] >= 100} <= got and all(a >= 100 for a, _ in got)
    led = op10_lines._led(sets, 4, 5).collect()
    assert len(led) == len({r["set"] for r in led}) > 0
    found = op10_lines._removed(docs, 4, 5, 1).collect()
    assert {r["doc"] for r in found} == {j for j, _ in near}


@pytest.mark.parametrize(("log", "chunk"), [(op6_substrings.AGAIN_LOG, 150), (op6_substrings.AGAIN_LOG, 10), (8, 30)])
def test_crowds_of_segments_shrink_to_runs(spark, monkeypatch, log, chunk):
    """Near copies have a segment each at an anchor, but few different runs of windows that others have, and no row for each window.

    With few texts a shard, or a filter that knows every window, runs go by window; results are those of brute force.
    """
    rng = np.random.default_rng(12)
    base = [f"b{x}" for x in range(150)]
    rows = [(i, " ".join(f"own{i}" if k == at else w for k, w in enumerate(base))) for i, at in enumerate(rng.integers(0, 150, 400))]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 400, 7)] + [(2000, rows[5][1] + " " + rows[9][1]), (2001, "short"), (2002, None)]
    sizes = []

    def counted(df):
        out = common.materialize(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(op6_substrings, "AGAIN_LOG", log)
    monkeypatch.setattr(op6_substrings, "materialize", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in op6_substrings.substring_dedup(docs, chunk=chunk).collect()}
    assert got == removed_windows(rows, 50)
    _, segments, *later = sizes
    assert segments > 400 and later
    if chunk == 150:
        assert max(later) < 2 * segments and later[-1] < segments // 3
