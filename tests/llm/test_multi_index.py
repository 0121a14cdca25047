"""Inverted multi-index: recall against brute force, the walk's order, ties, odd rows."""

import math

import numpy as np
import pytest
from candor.llm import multi_index as M
from candor.sources.tables import table
from llm_data import SF01

SCHEMA = "vec_id bigint, embedding array<float>, label int, cell int, vector string, score double"


def vectors_of(spark, rows):
    floats = lambda v: None if v is None else [None if x is None else float(x) for x in v]
    return spark.createDataFrame([(i, floats(v), 1, 2, "v", 0.5) for i, v in rows], SCHEMA)


def brute(rows, every=50, nearest=5):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in ok:
        if i % every == 0:
            near = [(-(q @ v) / math.sqrt((q @ q) * (v @ v)), k) for k, v in ok if k != i]
            out[i] = [(k, -s) for s, k in sorted(near)[:nearest]]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_few_vectors_and_odd_ones(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    rows += [(200, None), (250, []), (300, [0.0] * 6), (350, [1.0, None, 0, 0, 0, 0]), (400, [math.nan] + [1.0] * 5),
             (450, [math.inf] + [1.0] * 5), (None, [1.0] * 6), (500, [1e30] * 6), (501, [-0.0, 0, 0, 0, 0, 1e-30])]
    rows += [(600 + k, [1.0, 2, 3, 4, 5, 6]) for k in range(60)]  # equal vectors: ties go to smaller ids
    rows += [(600, [1.0, 2, 3, 4, 5, 6])]  # a row that repeats
    got = result(M.search(vectors_of(spark, rows), centroids=4, candidates=10**6))
    want = brute(rows)
    same(got, want)
    assert [v for v, _ in got[600]] == [601, 602, 603, 604, 605]
    assert [v for v, _ in got[650]] == [600, 601, 602, 603, 604]


def test_two_vectors_and_none(spark):
    got = result(M.search(vectors_of(spark, [(50, [1.0, 0.0]), (51, [1.0, 1.0])])))
    assert got.keys() == {50} and got[50][0][0] == 51 and len(got[50]) == 1
    assert M.search(vectors_of(spark, [])).count() == 0
    assert M.search(vectors_of(spark, [(50, [1.0, 0.0])])).count() == 0


def test_walk_is_by_summed_distance():
    rng = np.random.default_rng(2)
    index = M.MultiIndex(rng.normal(size=(300, 8)), 7)
    sizes = rng.integers(0, 3, 49)
    first, second = rng.random(7), rng.random(7)
    cells = index.walk(first, second, sizes, 10**9)
    total = [first[c // 7] + second[c % 7] for c in cells]
    assert total == sorted(total) and sorted(cells) == np.flatnonzero(sizes).tolist()
    some = index.walk(first, second, sizes, 10)
    assert some == cells[:len(some)] and sizes[some].sum() >= 10 > sizes[some[:-1]].sum()


def test_hot_cells_are_split(monkeypatch):
    monkeypatch.setattr(M, "SHARD", 10)
    dealt = M._dealt(np.array([3, 4, 5, 35, 2, 0, 9, 1]))
    assert dealt == [[0], [0], [1], [2, 3, 4, 5], [6], [6], [7], [7]]


def test_split_cells_and_parts_find_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    monkeypatch.setattr(M, "SHARD", 16)
    monkeypatch.setattr(M, "PART", 3)
    same(result(M.search(vectors_of(spark, rows), every=10, centroids=2, candidates=10**6)), brute(rows, every=10))


def test_recall_on_the_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, SF01, "embeddings").collect()]
    got, want = result(M.op7_multi_index(spark, SF01)), brute(rows)
    hits = sum(len({k for k, _ in got[q]} & {k for k, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
