"""Hard negatives against all scores; the tree's boxes and queue against plain scans."""

import numpy as np
import pytest

from candor.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, ids int, slab string, rank int"


def brute(rows, positives=5, negatives=10):
    whole = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) or abs(x) >= 2**16 for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        got = (label, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        whole[i] = min(got, whole.get(i, got))
    sizes = sorted((-sum(len(v) == n for _, v in whole.values()), n) for n in {len(v) for _, v in whole.values()})
    whole = {i: r for i, r in whole.items() if len(r[1]) == sizes[0][1]}
    out = set()
    for a, (label, q) in whole.items():
        if a % 100:
            continue
        score = {i: sum(x * y for x, y in zip(q, v, strict=True)) for i, (_, v) in whole.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if whole[i][0] == label][:positives]:
            found = [i for i in order if whole[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]][:negatives]
            out |= {(a, p, k, i, score[p], score[i]) for k, i in enumerate(found, 1)}
    return out


def mined(spark, rows):
    got = H.mine(spark.createDataFrame([(i, v, y, "x", 1, "s", 2) for i, v, y in rows], SCHEMA)).collect()
    assert len(got) == len({tuple(r) for r in got})
    return {tuple(r) for r in got}


def vectors(n, dims=6, copies=0, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)).astype(np.float32)
    if copies:
        x[rng.permutation(n)[:copies]] = np.float32(0.7)
    return [(i, x[i].tolist(), int(rng.integers(0, 10))) for i in range(n)]


NAN, INF = float("nan"), float("inf")
ODD = [*vectors(220), (None, [1.0] * 6, 1), (300, None, 1), (400, [1.0] * 6, None), (500, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (600, [NAN] * 6, 1), (700, [INF] * 6, 2),
       (800, [1.0] * 5, 1), (900, [3e4] * 6, 3), (901, [3e4] * 6, 3), (902, [2.5e4] * 6, 4), (1000, [1e30] * 6, 1), (0, [0.5] * 6, 9), (1100, [0.0] * 6, 2), (-100, [0.3] * 6, -3)]


@pytest.mark.parametrize("rows", [ODD, ODD + ODD, vectors(600, copies=250), [], [(100, [1.0, 2.0], 1)], [(None, None, None)]],
                         ids=["odd", "twice", "copies", "empty", "one", "nulls"])
def test_all_scores(spark, rows):
    assert mined(spark, rows) == (brute(rows) if len(rows) > 1 else set())


def test_several_slabs_and_parts(spark, monkeypatch):
    monkeypatch.setattr(H, "SLAB", 60)
    monkeypatch.setattr(H, "PART", 2)
    rows = vectors(700, dims=4, copies=100)
    assert mined(spark, rows) == brute(rows)


def test_boxes_bound_all_products():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-300, 300, (5000, 5)).astype(float), rng.integers(-300, 300, (7, 5)).astype(float)
    tree = H.Tree(x, leaf=16, fan=4)
    assert sorted(tree.order.tolist()) == list(range(5000)) and len(tree.levels[-1][0]) == 1
    products = q @ x[tree.order].T
    for level, (low, high) in enumerate(tree.bounds(q)):
        width = 16 * 4**level
        for b in range(low.shape[1]):
            part = products[:, b * width:(b + 1) * width]
            assert (low[:, b] <= part.min(1)).all() and (high[:, b] >= part.max(1)).all()


def test_queue_opens_few_leaves_where_vectors_cluster():
    rng = np.random.default_rng(2)
    centre = rng.integers(-400, 400, (64, 4))
    x = (centre[rng.integers(0, 64, 8192)] + rng.integers(-6, 6, (8192, 4))).astype(float)
    tree = H.Tree(x, leaf=64)
    x = x[tree.order]
    opened = 0

    class Counted(np.ndarray):
        def __getitem__(self, at):
            nonlocal opened
            opened += isinstance(at, slice)
            return np.ndarray.__getitem__(self, at)

    fits = np.ones(len(x), bool).view(Counted)
    q = x[5]
    windows = [H._Window(None, None, 5)]
    H.walk(tree, x, [[i] for i in range(len(x))], fits, q, [(lo[0], hi[0]) for lo, hi in tree.bounds(q[None])], windows, -1)
    score = x @ q
    want = sorted((-score[i], i) for i in range(len(x)))[:5]
    assert windows[0].best == want and opened < 0.2 * len(tree.levels[0][0])
