"""The pipeline's stages against brute force on a small corpus."""

import base64
import collections
import hashlib

import numpy as np
import pytest

from granary.llm import op2_simhash, op7_toxicity, op9_mix
from tests.llm.test_llm import brute_lines, prose

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(9)
    texts = [prose(rng, 90) + "\n" + prose(rng, 40) for _ in range(240)]
    texts = [t.replace(" ", " grumbleplex ", 3) if i % 6 == 0 else t for i, t in enumerate(texts)]
    texts += [texts[1]] * 3 + [texts[2] + "\n" + prose(rng, 50), "", None]
    d = str(tmp_path_factory.mktemp("pipeline"))
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_pipeline(spark, folder):
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers as p

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, out = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema if i < 4 else None)
        out.append(docs.collect())
        assert i == 4 or docs.columns == columns
    first = spark.read.parquet(f"{folder}/documents.parquet")
    scored = op7_toxicity.score_table(first, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    assert {r["doc_id"] for r in out[0]} == {r["doc_id"] for r in scored if not r["rejected"]}
    assert sum(r["doc_id"] % 6 == 0 and r["doc_id"] < 240 for r in out[0]) <= 2 and len(out[0]) >= 195
    rows = [(r["doc_id"], r["text"]) for r in out[0]]
    gone = brute_lines(rows)
    want = {d: t if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]) for d, t in rows}
    assert {r["doc_id"]: r["text"] for r in out[1]} == want
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out[1])
    fp = {d: op2_simhash.fingerprint(t, corpus_pipeline.NEAR_WORDS) for d, t in want.items()}
    label = {d: d for d in fp}
    for a in sorted(fp):
        for b in sorted(fp):
            if a < b and (fp[a] ^ fp[b]).bit_count() <= corpus_pipeline.NEAR_BITS and label[a] != label[b]:
                lo, hi = sorted((label[a], label[b]))
                label = {d: lo if x == hi else x for d, x in label.items()}
    assert {r["doc_id"] for r in out[2]} == {d for d, x in label.items() if d == x}
    mixed = {r["doc_id"]: r["copies"] for r in op9_mix.mix_documents(spark.createDataFrame(out[2], first.schema)).collect()}
    assert collections.Counter(r["doc_id"] for r in out[3]) == collections.Counter({d: c for d, c in mixed.items() if c})
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(p.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(out[4]) == len(out[3])
    for r in out[4]:
        t = want[r["doc_id"]] or ""
        assert r["n_tokens"] == len(enc.encode_ordinary(t)) and r["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, out[4]))


def test_near_copies_against_all_pairs(spark):
    """Copies at a similarity of 0.8 and somewhat above go, those just below stay, whatever their fingerprints say."""
    rng = np.random.default_rng(12)
    texts = [[f"v{x}" for x in rng.integers(0, 500, 20 + 3 * i)] for i in range(60)]
    for i in range(60):
        for k in range(4):
            w = list(texts[i])
            for at in rng.choice(len(w), 1 + (i + k) % 4, replace=False):
                w[at] = f"new{i}x{k}"
            texts.append(w[: len(w) - k % 2 * (i % 12)])
    rows = [(i, " ".join(w).upper() if i % 3 else " ".join(w), "en", "s", 1) for i, w in enumerate(texts)] + [(500, "a b", "en", "s", 1), (501, "A  b", "en", "s", 1), (502, "a b c", "en", "s", 1)]
    sets = [{tuple(t.lower().split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for _, t, *_ in rows]
    label, linked, far = [r[0] for r in rows], 0, 0
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                linked += 1
                far += (op2_simhash.fingerprint(rows[i][1], 5) ^ op2_simhash.fingerprint(rows[j][1], 5)).bit_count() > corpus_pipeline.NEAR_BITS
                lo, hi = sorted((label[i], label[j]))
                label = [lo if x == hi else x for x in label]
    assert linked > 50 and far > 10
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()}
    assert got == {r[0] for r, x in zip(rows, label, strict=True) if r[0] == x}


def test_one_row_of_each_group_stays(spark):
    """Rows that share the smallest id, and rows without an id, are counted as rows."""
    t, u, v = ("one two three four five six seven", "other words that make up a text", "a third text of a few words")
    rows = [(1, t), (1, t), (2, t), (None, t), (None, u), (None, u), (3, v), (3, "an unlike text under one id"), (None, None), (None, "")]
    docs = spark.createDataFrame([(i, x, "en", "s", 1) for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = collections.Counter((r["doc_id"], r["text"] or "") for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect())
    assert got == collections.Counter([(1, t), (None, u), (3, v), (3, "an unlike text under one id"), (None, "")])


@pytest.mark.parametrize("limit", [None, 0])
def test_stages_keep_every_column(spark, folder, limit):
    """Clashing names, null ids, texts and sources, repeated rows and an empty table go through every stage."""
    extra = ["TEXT", "Score", "k", "th", "Size", "c0", "mark"]
    rows = [(i, None if i == 3 else f"line {i} of text\nsame line here\n" + " ".join(f"w{i}x{j}" for j in range(30)), None if i == 5 else "s", *["x"] * len(extra)) for i in range(12)]
    rows += [rows[0], (None, rows[1][1], None, *["y"] * len(extra))]
    docs = spark.createDataFrame(rows, ", ".join(f"a{i} {'long' if i == 0 else 'string'}" for i in range(3 + len(extra)))).toDF("doc_id", "text", "source", *extra)
    docs = docs if limit is None else docs.limit(limit)
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        n = out.count()
        assert n == 0 if limit == 0 else n > 0, name
    assert corpus_pipeline.bpe_round_trip(spark, docs, folder).count() == docs.count()
