"""Vector searches against exact products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkvigil.llm import ann, topk
from sparkvigil.llm.queries import QUERIES
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int"


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    return [(r["vec_id"], r["embedding"]) for r in rows]


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_of_the_query(spark, vectors):
    got = by_query(QUERIES["op9_ann"](spark, FOLDER).collect())
    want = brute.top(vectors, [i for i, _ in vectors if i % 20 == 0], 20)
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    exact = {(q, i): s for q in want for i, s in want[q]}
    assert all(s == pytest.approx(exact[q, i]) for q in got for i, s in got[q] if (q, i) in exact)


def odd_rows():
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(size=6).round(2).tolist(), 0) for i in range(300)]
    common = rows[0][1]
    rows += [(1000 + i, common, 1) for i in range(60)]
    rows += [(2000, None, 0), (2020, [0.0] * 6, 0), (2040, [math.nan] + [1.0] * 5, 0), (2060, [math.inf] * 6, 0)]
    rows += [(2080, [None] * 6, 0), (2100, [1.0, 2.0], 0), (2120, [], 0), (20, rows[20][1], 3)]
    rows += [(3000, [v * 40 for v in rows[7][1]], 0)]
    return rows


def test_odd_vectors(spark):
    table = spark.createDataFrame(odd_rows(), SCHEMA).selectExpr("*", "1 AS vector", "2 AS norm", "3 AS block")
    good = {i: v for i, v, _ in odd_rows() if v and len(v) == 6 and None not in v and all(map(math.isfinite, v))}
    asked = [i for i in good if i % 20 == 0]
    nearest = by_query(ann.nearest(table, F.col("vec_id") % 20 == 0, k=5, rerank=1.0, read=128, posted=128).collect())
    floats = {i: [float(np.float32(x)) for x in v] for i, v in good.items() if any(v)}
    want = brute.top(list(floats.items()), [i for i in asked if i in floats], 5)
    assert nearest.keys() == want.keys()
    for q in want:
        if q != 20:
            assert [i for i, _ in nearest[q]] == [i for i, _ in want[q]]
    assert 1000 in nearest and [i for i, _ in nearest[1000]][:2] in ([3000, 0], [0, 1001], [3000, want[1000][1][0]])
    exact = by_query(topk.search(table, F.col("vec_id") % 20 == 0, block_rows=64, chunk_rows=10).collect())
    whole = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in good.items()}
    want = brute.top(list(whole.items()), asked, 5)
    assert exact.keys() == want.keys()
    assert all(exact[q] == want[q] for q in want if q != 20)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ann.nearest(none, F.col("vec_id") % 20 == 0).collect() == []
    assert topk.search(none, F.col("vec_id") % 20 == 0).collect() == []


def test_blocks_and_chunks_do_not_change_answers(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    query = F.col("vec_id") % 50 == 0
    one = topk.search(table, query).collect()
    many = topk.search(table, query, block_rows=50, chunk_rows=3).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))
    few = by_query(ann.nearest(table, query, k=4, rerank=1.0, read=128, posted=128).collect())
    cut = by_query(ann.nearest(table, query, k=4, rerank=1.0, read=128, posted=128, block_rows=70, chunk_rows=3).collect())
    assert few == cut


def test_exact_query(spark, vectors):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors]
    got = by_query(QUERIES["op10_topk"](spark, FOLDER).collect())
    assert got == brute.top(whole, [i for i, _ in vectors if i % 50 == 0], 5)


def test_every_pruning_gives_the_same(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(4)
    base = rng.normal(size=(900, 5)) * rng.lognormal(0, 1.2, size=(900, 1)) * 200
    data = np.floor(base).astype(np.int64)
    ids = np.arange(900)
    rows = pa.table({"vec_id": pa.array(ids), "vector": pa.array(data.tolist())})
    asked = pa.table({"vec_id": pa.array(ids[::9]), "vector": pa.array(data[::9].tolist()), "bound": pa.array([None] * 100, pa.float64())})
    want = brute.top(list(zip(ids.tolist(), data.tolist(), strict=True)), ids[::9].tolist(), 5)
    for start in (0.0, 0.75, 2.0):
        monkeypatch.setattr(topk, "COORDINATE_FROM", start)
        monkeypatch.setattr(topk, "BUCKET_ROWS", 64)
        found = topk.search_block(rows, asked, 5).to_pylist()
        got = {}
        for r in sorted(found, key=lambda r: (r["query_id"], -r["score"], r["vec_id"])):
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert got == want
