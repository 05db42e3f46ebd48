"""Columns and codon sites of alignments against plain Python; letters do not move one by one."""

import re

import numpy as np
import pytest

from granary.functions.sequence import BASES, codon_table
from granary.operators import consensus


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    base = {g: rng.choice(list("ACGT"), n) for g, n in (("a", 301), ("b", 96), ("c", 97), ("d", 2))}
    out = []
    for g, s in base.items():
        for k in range(5):
            t = s[: len(s) - 7 * (k == 4)].copy()
            at = rng.choice(len(t), len(t) // 9) if len(t) else []
            t[at] = rng.choice(list("acgtN-?"), len(at))
            out.append((g, f"s{k % 4}", "".join(t)))
    return [*out, ("e", "s0", "ACGTAC"), ("f", "s0", None), ("f", "s1", "")]


def exchanges(df):
    return re.findall(r"Exchange (?!SinglePartition)hashpartitioning\((.*?), \d+\)", df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0])


def test_variable_columns_over_pieces(spark, rows):
    df = spark.createDataFrame(rows, "gene string, species string, s string")
    want = {}
    for g in {r[0] for r in rows}:
        own = [(sp, (s or "").upper()) for h, sp, s in rows if h == g]
        keep = [i for i in range(400) if len({s[i] for _, s in own if i < len(s)} - set("-N?")) > 1]
        for sp, s in own:
            if got := [(i + 1, s[i]) for i in keep if i < len(s)]:
                want[g, sp] = sorted(want.get((g, sp), []) + got)
    out = consensus.variable_columns(df, "gene", "species", "s")
    assert {(r["gene"], r["species"]): list(zip(r["positions"], r["seq"], strict=True)) for r in out.collect()} == want
    assert all(re.fullmatch(r"(gene|_at|species)#\d+(, (gene|_at|species)#\d+)*", x) for x in exchanges(out))


def rows_made(node):
    """(name, rows) of every operator of a plan that has run."""
    kind = node.getClass().getSimpleName()
    inner = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if kind.endswith("QueryStageExec") else [node.children().apply(i) for i in range(node.children().size())]
    m = node.metrics()
    own = [(kind, m.apply("numOutputRows").value())] if m.contains("numOutputRows") else []
    return own + [x for n in inner for x in rows_made(n)]


def test_variable_columns_make_no_row_for_a_letter(spark):
    """Long sequences, some shorter, with gaps, letters of other planes and several rows of a species; no operator makes more rows than there are pieces."""
    rng = np.random.default_rng(6)
    own = []
    for g, n in (("a", 2500), ("b", 1024), ("c", 1025), ("d", 3000)):
        base = rng.choice(list("ACGT"), n)
        for k in range(12):
            t = base[: n - 400 * (k % 3) * (g != "d")].copy()
            if g != "d":
                at = rng.choice(len(t), 60, replace=False)
                t[at] = rng.choice(list("acgtN-?\u03a9\u4e2d\U0001f9ec"), 60)
            else:
                t[rng.choice(n, 60, replace=False)] = rng.choice(list("-N?"))
            own.append((g, None if k == 11 else f"s{k % 10}", "".join(t)))
    own += [("e", "s0", "A" * 1500), ("e", "s1", "A" * 1200 + "-" * 300), ("f", "s0", "\U0001f9ecAC"), ("f", "s1", "-AG"), ("f", "s2", "AC"), ("g", "s0", "-A"), ("g", "s1", "\U0001f9ecA")]
    own += [("h", "s0", "\U0010f00dA\U00100041\U0010f00d"), ("h", "s1", "-AA\U0001f00d"), ("h", "s2", "\U0010f00d-")]
    want = {}
    for g in {r[0] for r in own}:
        of = [(sp, s.upper()) for h, sp, s in own if h == g]
        keep = [i for i in range(3000) if len({s[i] for _, s in of if i < len(s)} - set("-N?")) > 1]
        for sp, s in of:
            if got := [(i + 1, s[i]) for i in keep if i < len(s)]:
                want[g, sp] = sorted(want.get((g, sp), []) + got)
    assert {g for g, _ in want} == {"a", "b", "c", "f", "h"} and want["h", "s1"] == [(3, "A"), (4, "\U0001f00d")]
    out = consensus.variable_columns(spark.createDataFrame(own, "gene string, species string, s string"), "gene", "species", "s")
    assert {(r["gene"], r["species"]): list(zip(r["positions"], r["seq"], strict=True)) for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan()
    assert max(n for _, n in rows_made(plan)) <= sum(-(-len(s) // 1024) for _, _, s in own)
    assert "ReusedExchange" in plan.toString()  # sequences are derived and dealt once


def test_codon_sites_over_pieces(spark, rows):
    df = spark.createDataFrame(rows, "gene string, species string, s string")
    table, want = codon_table(), set()
    for g in {r[0] for r in rows}:
        for i in range(0, 400, 3):
            c = {(s or "").upper()[i : i + 3] for h, _, s in rows if h == g} & set(table)
            if c:
                kind = "constant" if len(c) == 1 else "synonymous" if len({table[x] for x in c}) == 1 else "nonsynonymous"
                head = {x[:2] for x in c}
                want.add((g, i // 3 + 1, kind, len(head) == 1 and len({table[min(head) + x] for x in BASES}) == 1))
    out = consensus.codon_sites(df, "gene", "species", "s")
    assert {tuple(r) for r in out.collect()} == want and out.count() == len(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and len(exchanges(out)) == 1
