"""Every query with SQL against DuckDB on the smallest tables; the others run."""

import math
import os

import duckdb
import pytest

from granary.plans import registry
from granary.queries import annotation, genes, hits, matrix, more, strings  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v


def ordered(rows):
    return sorted(rows, key=lambda r: [(x is not None, str(x)) for x in r])


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = ordered([[plain(r[c]) for c in cols] for r in df.collect()])
    if name not in registry.SQL:
        assert got
        return
    rel = db.sql(registry.SQL[name])
    at = [rel.columns.index(c) for c in cols]
    assert sorted(rel.columns) == cols
    assert got == ordered([[plain(r[i]) for i in at] for r in rel.fetchall()])
