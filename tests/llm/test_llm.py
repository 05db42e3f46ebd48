"""The training-data operators against brute force, with the odd inputs that their docstrings define."""

import base64
import collections
import hashlib
import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.llm import fm_index, op10_lines, op1_url_filter, op2_simhash, op3_bpe, op4_shards, op5_ann, op6_substrings, op7_toxicity, op8_quality, op9_mix
from granary.llm.graph import components

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()), T.StructField("size", T.StringType())])
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join("w" + str(int(x)) for x in rng.zipf(1.3, n) % 4000)


@pytest.fixture(scope="module")
def docs(spark):
    """Prose with exact and near copies, repeats, blanks, nulls, ties and clashing column names."""
    rng = np.random.default_rng(3)
    base = [prose(rng, 120) + "\n" + prose(rng, 60) for _ in range(30)]
    texts = list(base)
    texts += [base[0]] * 5
    for i in range(10):
        w = base[1].split(" ")
        w[5 + i] = f"changed{i}"
        texts.append(" ".join(w))
    texts += [base[2][:300] + " " + base[3], "", None, "   \n\t ", "one", "a b c", "x" * 5000, "A\x1cb \u2028 c é 漢字 👩‍👩‍👧 'll 'S 12345", prose(rng, 6000), "same line of five words\n" * 4]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 7 else None, None, "x", None) for i, t in enumerate(texts)]
    rows += [rows[0], (None, base[4], None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.mark.parametrize("url,host,path", [(None, "", ""), ("no scheme", "", ""), ("HTTP://A.Example.COM", "a.example.com", ""), ("x://h/p?q", "h", "/p"), ("x://h?y/z", "h", ""), ("x://h#y", "h", ""), ("x://h/a://b/c", "h", "/a://b/c")])
def test_op1_parts(spark, url, host, path):
    r = spark.createDataFrame([(url,)], "url string").select(op1_url_filter.url_host(F.col("url")), op1_url_filter.url_path(F.col("url"))).first()
    assert tuple(r) == (host, path)


def test_op1_cascade_is_exact(spark):
    names = [f"h{i}.example.com" for i in range(800)]
    listed = spark.createDataFrame([(n,) for n in names[::17]] + [("absent.org",), (None,)], "d string")
    urls = spark.createDataFrame([(i, f"http://sub.{n}/en/{i}", "?") for i, n in enumerate(names)] + [(-1, None, None)], "page_id long, url string, host string")
    rules = [op1_url_filter.parse_rule("example.com/en/7", "allow")]
    got = {r["page_id"]: (r["verdict"], r["rule"]) for r in op1_url_filter.filter_urls(urls, listed, rules).collect()}
    for i in range(800):
        ruled = str(i).startswith("7")
        assert got[i] == ("allow" if ruled or i % 17 else "block", "example.com/en/7" if ruled else None)
    assert got[-1] == ("allow", None)
    assert op1_url_filter.filter_urls(urls.limit(0), listed, rules).count() == 0


@pytest.mark.parametrize("limit", [4, 8])
def test_op2_against_all_pairs(docs, limit):
    rows = pairs(docs)
    fp = [op2_simhash.fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (fp[i] ^ fp[j]).bit_count() <= limit:
            a, b = label[i], label[j]
            label = [a if x == b else x for x in label]
    low = collections.defaultdict(list)
    for (d, _), x in zip(rows, label, strict=True):
        if d is not None:
            low[x].append(d)
    want = collections.Counter((d, f"{f:016x}", min(low[x], default=None)) for (d, _), f, x in zip(rows, fp, label, strict=True))
    got = op2_simhash.near_duplicates(docs, limit=limit).collect()
    assert collections.Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


def test_op2_crowded_cells_lose_no_link():
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 1 << 63))
    fps = np.unique(np.array([centre ^ sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(200)], np.uint64))
    for bands, limit in ((2, 4), (3, 8)):
        k, f = op2_simhash.cells(fps, bands)
        order = np.argsort(k, kind="stable")
        e = op2_simhash.links_in_cells(k[order], f[order], limit, bands)
        assert (np.bitwise_count(e[:, 0] ^ e[:, 1]) <= limit).all()
        seen, todo = {int(e[0, 0])}, [int(e[0, 0])]
        nb = collections.defaultdict(set)
        for a, b in e.tolist():
            nb[a].add(b)
            nb[b].add(a)
        while todo:
            for x in nb[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert seen == set(fps.tolist())


def test_op2_empty(empty):
    assert op2_simhash.near_duplicates(empty).count() == 0


def test_components_of_a_path(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    got = {r["node"]: r["label"] for r in components(e).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


@pytest.fixture(scope="module")
def tokenizer():
    p = pytest.importorskip("public_tokenizers")
    import tiktoken

    path = p.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return op3_bpe.Vocabulary.read(path), p.PATTERN, tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_op3_digests(docs, empty, tokenizer):
    v, pattern, ref = tokenizer
    text = dict(pairs(docs))
    for r in op3_bpe.encode_digests(docs, v, pattern).collect():
        t = text[r["doc_id"]] or ""
        ids = np.array(ref.encode_ordinary(t), "<u4")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    coded = op3_bpe.encode_table(docs, v, pattern)
    assert all(bytes(r["data"]).decode() == (text[r["doc_id"]] or "") for r in op3_bpe.decode_table(coded, v).collect())
    assert op3_bpe.encode_digests(empty, v, pattern).count() == 0


def test_op3_full_memo_and_perfect_hash(tokenizer):
    v, pattern, ref = tokenizer
    e = op3_bpe.Encoder(v, pattern, room=3)
    t = "several different words that overflow a tiny memo, several times over " + "ab" * 3000
    assert list(e.encode(t)) == ref.encode_ordinary(t)
    assert all(v.whole.get(w) == i for i, w in enumerate(v.words) if w is not None)
    assert v.whole.get(b"surely not an entry") == -1


def test_op4_law(docs, empty):
    weights = [1.0] * 16
    got = op4_shards.shard_table(docs, weights).collect()
    assert len(got) == docs.count()
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    more = {r["doc_id"]: r["shard"] for r in op4_shards.shard_table(docs, weights + [1.0]).collect()}
    assert all(more[r["doc_id"]] == r["grown_shard"] for r in got)
    import zlib

    text = dict(pairs(docs))
    assert all((r["size"], r["text_crc32"]) == (len((text[r["doc_id"]] or "").encode()) + 1, zlib.crc32((text[r["doc_id"]] or "").encode())) for r in got)
    assert op4_shards.shard_table(empty, weights).count() == 0


def test_op4_weights(spark):
    got = op4_shards.shard_table(spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")), [1.0, 3.0])
    n = {r["shard"]: r["count"] for r in got.groupBy("shard").count().collect()}
    assert 2.6 < n[1] / n[0] < 3.4


def test_op5_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(1500, 16))
    m[100:400] = m[100]  # a third of one vector, nearly
    bad = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 3]
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(m)] + [(2000 + 20 * i, v, 1) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = op5_ann.nearest(df, F.col("vec_id") % 20 == 0, k=20).collect()
    by = collections.defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(by) == set(range(0, 1500, 20))
    hit = 0
    for q in by:
        s = m @ m[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(1500), -s))[:20]
        hit += len(set(want.tolist()) & {v for v, _ in by[q]})
        assert [v for v, _ in by[q]] == [v for v, _ in sorted(by[q], key=lambda x: (-x[1], x[0]))]
        assert all(abs(x - float(m[v] @ m[q])) < 1e-9 for v, x in by[q])
    assert hit / (20 * len(by)) >= 0.9
    assert op5_ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert op5_ann.nearest(df.where("vec_id < 5"), F.col("vec_id") % 20 == 0).count() == 4


@pytest.mark.parametrize("length", [2, 4, 7])
def test_fm_index_against_brute_force(length):
    rng = np.random.default_rng(length)
    texts = [rng.integers(1, 4, rng.integers(1, 40)) for _ in range(40)]
    owners = rng.integers(0, 30, 40)
    found = fm_index.FMIndex(texts, owners, 4).repeated(texts, owners, length)
    for i, t in enumerate(texts):
        want = set()
        for a in range(len(t) - length + 1):
            w = t[a : a + length].tolist()
            if any(owners[j] < owners[i] and any(u[b : b + length].tolist() == w for b in range(len(u) - length + 1)) for j, u in enumerate(texts)):
                want |= set(range(a, a + length))
        assert {x for a, b in found[i] for x in range(a, b)} == want


def removed_windows(rows, window):
    first, out = {}, {}
    for d, t in sorted(((d, t) for d, t in rows if d is not None), key=lambda x: x[0]):
        w = (t or "").encode().split()
        gone, mine = set(), []
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if first.get(k, d) < d:
                gone |= set(range(i, i + window))
            mine.append(k)
        for k in mine:
            first.setdefault(k, d)
        out[d] = (len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())
    return out


@pytest.mark.parametrize("chunk", [2000, 2, 0])
def test_op6_against_brute_force(docs, chunk):
    want = removed_windows(pairs(docs), 50)
    assert sum(x[1] for x in want.values()) > 1000
    for r in op6_substrings.substring_dedup(docs, texts=True, chunk=chunk).collect():
        assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]
        if r["doc_id"] is not None:
            assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == want[r["doc_id"]]


def test_op6_empty(empty):
    assert op6_substrings.substring_dedup(empty).count() == 0


def test_op7_held_out(spark, empty):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        t = prose(rng, 80)
        if toxic:
            t = t.replace(" ", " grumbleplex ", 2) if i % 2 else t.replace(" ", f" zorksuffix{'abcdefgh'[i % 8]} ", 2)
        rows.append((i, t, "en" if i % 2 else "de", None, None, "clash", None))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows + [(9001, None, None, None, None, None, None), (None, "", None, None, None, None, None)], DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = op7_toxicity.score_table(docs, lab).select("doc_id", "held_out", "score", "predicted").collect()
    assert len(got) == 1502 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["held_out"]]
    assert 350 < len(held) < 650
    assert sum((r["doc_id"] % 5 == 0) == bool(r["predicted"]) for r in held) / len(held) > 0.97
    assert op7_toxicity.score_table(empty, lab).count() == 0
    assert {r["score"] for r in op7_toxicity.score_table(docs.limit(3), lab.limit(0)).collect()} == {0.0}


def test_op8_counts(docs, empty):
    text = dict(pairs(docs))
    for r in op8_quality.apply_quality(docs).collect():
        t = text[r["doc_id"]] or ""
        w = SPLIT.findall(t)
        c = collections.Counter(zip(w, w[1:], w[2:]))
        cover = {i + k for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if SPLIT.search(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(w) < 50 or 100 * len(cover) > 50 * len(w))
        assert not (r["base_failed"] and r["kept"])
    assert op8_quality.apply_quality(empty).count() == 0


def test_op8_order_does_not_change_the_verdict(docs):
    a, b = (sorted((str(r["doc_id"]), r["kept"]) for r in op8_quality.apply_quality(docs, ordered=o).collect()) for o in (list(op8_quality.RULES), list(op8_quality.RULES)[::-1]))
    assert a == b


def test_op9_targets_and_flow():
    t = op9_mix.share_targets({"a": 100, "b": 1000, None: 10})
    assert t["a"] == 200 and t[None] == 20 and abs(sum(t.values()) - 1.5 * 1110) < 1e-6
    shares = op9_mix.min_cost_flow([((0,), 10), ((0, 1), 10), ((1,), 10)], [20, 10])
    by = collections.Counter()
    for s in shares:
        by[s.source] += s.words
    assert by == {0: 20, 1: 10} and not any(s.copy for s in shares)  # nothing need be repeated
    shares = op9_mix.min_cost_flow([((0,), 10), ((1,), 10)], [15, 5])
    assert sum(s.words for s in shares if s.copy == 1) == 5


def test_op9_mix(spark, empty):
    rng = np.random.default_rng(6)
    rows = [(i, prose(rng, 1 + i % 40), None, f"s{min(i % 6, 3)}" if i % 11 else None, None, "x", None) for i in range(900)] + [(901, None, None, "s1", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    got = op9_mix.mix_documents(docs).collect()
    again = op9_mix.mix_documents(docs.repartition(3)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in got) == sorted((r["doc_id"], r["taken"]) for r in again)
    total = collections.Counter()
    for r in got:
        total[r["source"]] += r["taken"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    for r in got:
        assert abs(total[r["source"]] - r["target"]) <= 80
    assert op9_mix.mix_documents(empty).count() == 0


def brute_lines(rows):
    out, seen, inv = collections.defaultdict(set), [], collections.defaultdict(list)
    for d, t in sorted({(d, t) for d, t in rows if d is not None}, key=lambda x: x[0]):
        for i, line in enumerate((t or "").split("\n")):
            s = frozenset(SPLIT.findall(line))
            if len(s) < 5:
                continue
            c = collections.Counter(itertools.chain.from_iterable(inv[w] for w in s))
            if any(5 * n >= 4 * (len(s) + len(seen[j]) - n) for j, n in c.items()):
                out[d].add(i)
            for w in s:
                inv[w].append(len(seen))
            seen.append(s)
    return out


def test_op10_against_brute_force(docs, empty):
    rows = pairs(docs)
    want, text = brute_lines(rows), dict(rows)
    assert sum(map(len, want.values())) > 10
    for r in op10_lines.dedup_report(docs).collect():
        assert set(r["removed_lines"]) == (want[r["doc_id"]] if r["doc_id"] is not None else set())
    kept = op10_lines.dedup_lines(docs).collect()
    assert len(kept) == len(rows)
    for r in kept:
        t = text[r["doc_id"]]
        gone = want[r["doc_id"]] if r["doc_id"] is not None else set()
        assert r["text"] == (t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone))
    assert op10_lines.dedup_report(empty).count() == 0


def test_op10_refuted_leaders(spark):
    """A line that its leader only seems to match still finds the line that does."""
    rng = np.random.default_rng(8)
    base = [f"t{i}" for i in range(40)]
    rows = []
    for i in range(60):
        w = list(base)
        for k in rng.choice(40, int(rng.integers(0, 9)), replace=False):
            w[k] = f"n{i}x{k}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: bool(r["n_removed"]) for r in op10_lines.dedup_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_lines(rows)
    assert got == {i: bool(want[i]) for i in range(60)}


def test_op7_thresholds_use_all_labelled_rows(spark):
    """Thresholds are those of every labelled row of the calibration fold, at its class mix and with long texts."""
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(2400):
        toxic, strong = i % 10 == 0, rng.random()
        t = prose(rng, 30)
        if toxic and strong < 0.5:
            t = t.replace(" ", " grumbleplex ", 1)
        elif toxic or strong < 0.4:  # at the true mix one in eight is toxic, in a sample of halves more than one in two
            t = t.replace(" ", " mumbleplex ", 1)
        if i % 40 == 0:
            t += " " + " ".join(["calm"] * 4000)
        rows.append((i, t, ("en", "de", None)[i % 3]))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model, cut = op7_toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), max_fit_rows=300)
    import zlib

    scorer, y = op7_toxicity.Scorer(model), dict(labels)
    check = [(g or "", y[i], scorer.score(t)) for i, t, g in rows if zlib.crc32(str(i).encode()) % 3 == 2]
    assert len(check) > 300 and any(len(t) > 16000 for _, t, _ in rows)
    want = {}
    for g in ("", "de", "en"):
        s = [(a, b) for x, a, b in check if not g or x == g]
        f1 = {t: 2 * sum(a for a, b in s if b >= t) / (sum(b >= t for _, b in s) + sum(a for a, _ in s)) for t in np.linspace(0.3, 0.7, 9)}
        want[g] = max(f1, key=lambda t: (f1[t], t)) if 5 <= sum(a for a, _ in s) <= len(s) - 5 else 0.7
    assert cut == want


def test_op10_short_lines(spark):
    """Lines of one to six distinct words against brute force: equal sets below four, and four words against five."""
    rng = np.random.default_rng(11)
    rows = [(i, "\n".join(" ".join(f"q{x}" for x in rng.integers(0, 9, rng.integers(0, 7))) for _ in range(6))) for i in range(120)]
    rows += [(200, "Les.\n\nLes."), (201, "Les.\n  \nLes. Les."), (202, "z1 z2 z3 z4 z5\nz1 z2 z3 z4"), (203, "y1 y2 y3 y4"), (204, "y5 y4 y3 y2 y1\nx1 x2 x3"), (205, "x1 x2 x3 x4"), (None, "Les.")]
    want, seen = collections.defaultdict(set), []
    for d, t in rows[:-1]:
        for i, line in enumerate(t.split("\n")):
            if s := frozenset(SPLIT.findall(line)):
                if any(5 * len(s & o) >= 4 * len(s | o) for o in seen):
                    want[d].add(i)
                seen.append(s)
    assert want[200] == {2} and want[201] == {0, 2} and want[202] == {1} and want[204] == {0} and not want[205]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: set(r["removed_lines"]) for r in op10_lines.dedup_report(docs).collect()}
    assert got == {d: want[d] if d is not None else set() for d, _ in rows}
