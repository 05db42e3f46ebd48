"""Odd tables for every operator and stage: clashing names, repeated rows and ids, ties, very long texts; and the registered queries themselves."""

import collections
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import op1_url_filter, op2_simhash, op3_bpe, op4_shards, op5_ann, op6_substrings, op7_toxicity, op8_quality, op9_mix, op10_lines, queries
from tests.llm.test_llm import SPLIT, prose, removed_windows

CLASH = ["Doc_Id", "TEXT", "c0", "doc", "th", "HOST", "Rule", "verdict", "Score", "held_out", "Size", "_k", "k", "h", "Copies", "members", "removed", "_removed", "set", "words0", "LANG"]


@pytest.fixture(scope="module")
def clashing(spark):
    """doc_id, text, source, lang and every name of CLASH, with null keys, texts and sources, repeated rows and a very long text."""
    rng = np.random.default_rng(8)
    texts = [prose(rng, 80) + "\nsame short line\n" + prose(rng, 20) for _ in range(12)] + [None, "", prose(rng, 30_000)]
    rows = [(i, t, None if i % 5 == 0 else f"s{i % 2}", "en", *["x"] * len(CLASH)) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (0, texts[3], "s1", "en", *["y"] * len(CLASH)), (None, texts[2], None, None, *["z"] * len(CLASH))]
    names = ["doc_id", "text", "source", "lang"]
    df = spark.createDataFrame(rows, ", ".join(f"a{i} {'long' if i == 0 else 'string'}" for i in range(4 + len(CLASH))))
    return df.toDF(*names, *CLASH)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, "x") for i in range(12)], "doc_id long, toxic int, TEXT string")


@pytest.mark.parametrize("limit", [None, 0])
def test_clashing_names(spark, clashing, labels, limit):
    docs = clashing if limit is None else clashing.limit(limit)
    n = docs.count()
    rules = [op1_url_filter.parse_rule("com/en/", "block")]
    listed = spark.createDataFrame([("a.com",)], "TEXT string")
    pages = op1_url_filter.filter_urls(docs, listed, rules, url="text")
    assert pages.columns[-4:] == ["host", "path", "rule", "verdict"] and pages.count() == n and "HOST" not in pages.columns
    assert op2_simhash.near_duplicates(docs).count() == n
    assert op3_bpe.encode_digests(docs, queries.default_vocabulary(), queries.default_pattern()).count() == n
    assert op4_shards.shard_table(docs, [1.0] * 4).count() == n
    assert op6_substrings.substring_dedup(docs).count() == n
    scored = op7_toxicity.score_table(docs, labels)
    assert scored.columns[-4:] == ["held_out", "score", "predicted", "rejected"] and "Score" not in scored.columns and scored.count() == n
    assert op8_quality.apply_quality(docs).count() == n
    mixed = op9_mix.mix_documents(docs)
    assert mixed.count() == n and "Size" not in mixed.columns and "_k" in mixed.columns
    lines = op10_lines.dedup_lines(docs)
    assert lines.columns == docs.columns and lines.count() == n
    assert op10_lines.dedup_report(docs).count() == n


def test_line_removal_is_by_row(spark):
    """Two texts under one id are two documents, and string ids are ordered like others."""
    one, other = "the quick brown fox jumps over", "entirely different words stand here today"
    rows = [(1, one), (2, one), (2, other), (3, "a\n" + one + "\nb c d"), (3, "a\n" + one + "\nb c d"), (None, one)]
    for kind in ("long", "string"):
        docs = spark.createDataFrame([(i if i is None or kind == "long" else str(i), t) for i, t in rows], f"doc_id {kind}, text string")
        got = collections.Counter((None if r[0] is None else int(r[0]), r["text"]) for r in op10_lines.dedup_lines(docs).collect())
        assert got == collections.Counter([(1, one), (2, ""), (2, other), (3, "a\nb c d"), (3, "a\nb c d"), (None, one)])


def test_kept_against_plain_rules(spark):
    rng = np.random.default_rng(1)
    base = prose(rng, 90)
    texts = [base, base.upper(), base.replace(" ", " ! "), base.replace(" ", " # "), "\n".join([prose(rng, 9) + "..." for _ in range(9)]), "\n".join("- " + prose(rng, 8) for _ in range(9)), "\n".join([prose(rng, 10)] * 3 + [prose(rng, 40)]), " ".join("x" * 20 for _ in range(60)) + " " + base, base + "\n" + base, prose(rng, 20), "", None]
    texts += [" ".join(f"a{i}b{j}c" for i in range(60)) + "!" * k for j, k in enumerate(range(20, 45, 5))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = set()
    for r in op8_quality.apply_quality(docs).collect():
        t = texts[r["doc_id"]] or ""
        w, lines = SPLIT.findall(t), [x for x in t.split("\n") if SPLIT.search(x)]
        chars, n = sum(map(len, w)), len(w)
        rejects = (
            10 * r["n_symbols"] > chars, 2 * r["n_dup_lines"] > len(lines), chars < 2 * n or chars > 15 * n, 5 * len(re.findall("[A-Z]", t)) > 2 * chars, 2 * t.count("!") > n,
            10 * sum(x.rstrip(" ").endswith(("...", "…")) for x in lines) > 3 * len(lines), 10 * sum(x.lstrip(" ").startswith(("-", "*", "•")) for x in lines) > 9 * len(lines),
        )
        assert r["kept"] == (not r["base_failed"] and not any(rejects))
        seen.add((r["base_failed"], r["kept"]))
    assert seen == {(True, False), (False, False), (False, True)}


def test_rules_order_is_conditional():
    hit = np.array([[1, 1, 0]] * 60 + [[0, 0, 1]] * 20 + [[0, 0, 0]] * 20, bool)
    assert op8_quality.best_order(hit, [1.0, 1.1, 1.0]) == [0, 2, 1]  # what rule 1 rejects is gone after rule 0


def test_mix_of_equal_rows(spark):
    """Equal rows at a cut are counted out, and rows of one id with different texts are apart."""
    rows = [(7, "one two three four five six seven eight nine ten", "a")] * 500 + [(7, " ".join(["w"] * (i % 9 + 1)), "b") for i in range(300)] + [(i, "x y", "c") for i in range(50)]
    got = op9_mix.mix_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows)
    taken, target = collections.Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)


def test_mix_of_overlapping_sources(spark):
    """Documents of several sources: quotas are met as a flow over membership patterns can."""
    rng = np.random.default_rng(2)
    kinds = [["a"], ["a", "b"], ["b"], ["b", "c"], ["c", "a"], ["d"]]
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 9))), kinds[i % 6] + kinds[i % 6][:1]) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, of array<string>")
    got = op9_mix.mix_sources(docs, F.col("of"), F.size(F.split("text", " "))).collect()
    words, total, served, used = collections.Counter(), collections.Counter(), collections.Counter(), 0
    for r in got:
        assert r["_members"] == sorted(set(kinds[r["doc_id"] % 6]))
        for s in r["_members"]:
            total[s] += r["size"]
        used += r["taken"]
        words[tuple(r["_members"])] += r["taken"]
        assert len(r["serves"]) == r["copies"] and set(r["serves"]) <= set(r["_members"])
        for s in r["serves"]:
            served[s] += r["size"]
    targets = op9_mix.share_targets(dict(total), total_share=1.5 * sum(r["size"] for r in got) / sum(total.values()))
    assert abs(used - sum(targets.values())) <= 200  # a cut misses by less than a document for each pattern and copy
    for s in targets:  # what can serve a source is at least its target
        assert sum(n for m, n in words.items() if s in m) >= targets[s] - 100
        assert abs(served[s] - targets[s]) <= 100


def test_route_equals_flow():
    rng = np.random.default_rng(4)
    patterns = [((i,), int(rng.integers(0, 50))) for i in range(5)] + [((5, 6), 30), ((6,), 10)]
    quotas = [int(x) for x in rng.integers(0, 90, 7)]
    by = lambda shares: {(x.pattern, x.source, x.copy): x.words for x in shares if x.words}
    alone = lambda shares: {k: v for k, v in by(shares).items() if k[0] < 5}
    assert alone(op9_mix.route(patterns, quotas)) == alone(op9_mix.min_cost_flow(patterns, quotas))


def test_shards_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(op4_shards, "RUN", 7)
    rows = [(1, "same")] * 100 + [(1, f"other {i % 3}") for i in range(9)] + [(None, None)] * 5
    got = op4_shards.shard_table(spark.createDataFrame(rows, "doc_id long, text string"), [1.0] * 4).collect()
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert len(got) == 114 and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_hot_passage_goes_by_window(spark):
    """One passage in many different contexts; more texts share its anchor than a shard takes."""
    rng = np.random.default_rng(5)
    passage = " ".join(f"p{i}" for i in range(57))
    rows = [(i, " ".join(f"x{i}y{j}" for j in range(int(rng.integers(20, 60)))) + " " + passage + " " + " ".join(f"z{i}y{j}" for j in range(30))) for i in range(400)]
    rows += [rows[7], (500, rows[9][1])]
    want = removed_windows(rows, 50)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in op6_substrings.substring_dedup(docs, chunk=50).collect()}
    assert got == want and sum(x[1] for x in want.values()) > 20_000


def test_crowded_cells_by_blocks(monkeypatch):
    rng = np.random.default_rng(6)
    f = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    f = np.unique(np.concatenate([f, f[:60] ^ np.uint64(0b1011), f[:30] ^ np.uint64(1 << 60)]))
    find = lambda parts: {frozenset(g) for g in _groups([e for part in parts for e in op2_simhash._spanning(part, 4)])}
    assert find(op2_simhash._blocks(f, 4)) == find([f])


def _groups(edges):
    label = {}
    for a, b in edges:
        x, y = label.setdefault(a, a), label.setdefault(b, b)
        if x != y:
            label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
    out = collections.defaultdict(set)
    for k, v in label.items():
        out[v].add(k)
    return out.values()


def test_repeated_query_ids(spark):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(200, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(0, [float(x) for x in m[5]])]
    got = op5_ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    mine = [r for r in got if r["query_id"] == 0]
    q = min(m[0].tolist(), m[5].tolist())
    assert len(mine) == 20 and all(abs(r["score"] - float(np.dot(m[r["vec_id"]], q))) < 1e-9 for r in mine) and 0 not in {r["vec_id"] for r in mine}


def test_registered_queries(spark):
    """Each query over its whole small table: columns of its contract, a row a document, equal to the operators' answers where these are cheap to restate."""
    d = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    first = {
        "op1_url_filters": ["page_id", "host", "path", "rule", "verdict"],
        "op2_simhash_groups": ["doc_id", "fingerprint", "component_id"],
        "op3_bpe_round_trip": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        "op4_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op5_nearest_vectors": ["query_id", "rank", "vec_id", "score"],
        "op6_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
        "op7_toxicity_scores": ["doc_id", "held_out", "score", "predicted"],
        "op8_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
        "op9_source_mix": ["doc_id", "size", "source_size", "target", "taken"],
        "op10_line_dedup": ["doc_id", "n_lines", "n_removed", "removed_lines"],
    }
    assert list(first) == list(queries.QUERIES)
    got = {}
    for name, f in queries.QUERIES.items():
        df = f(spark, d)
        assert df.columns[: len(first[name])] == first[name], name
        got[name] = df.collect()
        if df.columns[0] == "doc_id":
            assert sorted(r["doc_id"] for r in got[name]) == sorted(docs), name
    assert all(r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest() for r in got["op3_bpe_round_trip"])
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got["op6_substring_dedup"]} == removed_windows(docs.items(), 50)
    fp = {i: op2_simhash.fingerprint(t) for i, t in docs.items()}
    near = _groups([(min(a, b), max(a, b)) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4])
    label = {i: i for i in fp} | {i: min(g) for g in near for i in g}
    assert all((int(r["fingerprint"], 16), r["component_id"]) == (fp[r["doc_id"]], label[r["doc_id"]]) for r in got["op2_simhash_groups"])


def test_url_query_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{d}/pages.parquet'")
    want = sorted(con.execute(queries.ORACLE_SQL["op1_url_filters"]).fetchall(), key=str)
    assert sorted((tuple(r) for r in queries.op1_url_filters(spark, d).collect()), key=str) == want


def test_shared_folder(spark):
    from types import SimpleNamespace

    from granary.llm.common import shared_dir, tidy

    def fake(master):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=sc)

    assert shared_dir(fake("local[3]")).startswith("file:///") and shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_dir(fake(master))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with pytest.raises(KeyError), tidy(spark):
        assert spark.conf.get(key) == "true"
        raise KeyError
    assert spark.conf.get(key) == before


def test_positional_names(spark):
    from granary.llm.common import Plain

    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("Text", "text", "Other")
    p = Plain(df)
    assert (p["text"], p["Text"], p["TEXT"], p["other"], p.find("none")) == ("c1", "c0", "c0", "c2", None)
    out = p.back(p.df.withColumn("OTHER", F.lit(9)), "OTHER")
    assert out.columns == ["Text", "text", "OTHER"] and tuple(out.first()) == (1, 2, 9)


def test_filter_holds_every_key(spark):
    from granary.llm.common import bit_filter

    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    held = bit_filter(keys, bits=1 << 16)
    assert keys.where(held.holds(F.col("key"))).count() == 5000
    others = spark.range(10_000, 20_000).select(F.xxhash64("id").alias("key"))
    assert others.where(held.holds(F.col("key"))).count() < 1000
