"""Toxicity: held-out accuracy, misspellings, what training may see, odd rows."""

import random
import zlib

import numpy as np
from candor.llm import toxicity as T
from candor.sources.tables import table
from llm_data import ODD, SF01, docs_of

BAD = ["idiot", "worthless", "disgusting", "pathetic", "scumbag"]


def made(rng, n, bad):
    words = ["".join(rng.choice(["an", "the", "or", "in", "ti", "on", "re", "ble", "sh"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    for _ in range(bad):
        words[rng.randrange(n)] = rng.choice(BAD)
    return " ".join(words)


def sample(seed, n):
    rng = random.Random(seed)
    rows = [(k, made(rng, rng.randint(20, 200), 4 if k % 3 == 0 else 0), int(k % 3 == 0)) for k in range(n)]
    return rows


def test_held_out_accuracy_and_misspellings(spark):
    rows = sample(1, 900)
    docs = docs_of(spark, [(i, t, "a") for i, t, _ in rows])
    labels = spark.createDataFrame([(i, 1, y, "x") for i, _, y in rows], "doc_id bigint, quality int, toxic int, score string")
    model = T.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in T.score(docs, model).collect()}
    held = [(got[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((s >= 0.5) == y for s, y in held) >= 0.95 * len(held)
    odd = docs_of(spark, [(1, "the ontion worthlesss and or disgustingg sh the", "a"), (2, "the ontion ortion and or shble sh the", "a")])
    a, b = (r["score"] for r in T.score(odd, model).orderBy("doc_id").collect())
    assert a > 0.5 > b
    kept = T.clean_documents(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}


def test_gradients():
    shares, grams = T._bags(["a b stupid", "b c", "stupid stupid c"], 1)
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(T.BUCKETS, 2)).astype(np.float32), rng.normal(size=(3, 2)).astype(np.float32)
    forward, back = shares.dot(grams.dot(x)), grams.t_dot(shares.t_dot(y))
    assert np.isclose((forward * y).sum(), (x * back).sum(), rtol=1e-4)
    for word in ["a", "Stupid.", "...", "", "it's", "é" * 9]:
        assert len(T.subwords(word)) == T.n_subwords(word)
    means = [np.mean([x[T.subwords(w)].sum(0) for w in t.split()], axis=0) for t in ["b c"]]
    n = sum(T.n_subwords(w) for w in "b c".split())
    assert np.allclose(forward[1], means[0] * 2 / n, atol=1e-5)


def test_labels_of_the_held_out_part_change_nothing(spark):
    rows = sample(2, 200)
    docs = docs_of(spark, [(i, t, "a") for i, t, _ in rows])
    schema = "doc_id bigint, quality int, toxic int"
    one = spark.createDataFrame([(i, 1, y) for i, _, y in rows], schema)
    two = spark.createDataFrame([(i, 1, y if zlib.crc32(str(i).encode()) % 5 else 1 - y) for i, _, y in rows], schema)
    a, b = T.train(docs, one), T.train(docs, two)
    assert (a.logits == b.logits).all() and a.bias == b.bias


def test_odd_rows(spark, odd, empty):
    schema = "doc_id bigint, quality int, toxic int"
    labels = spark.createDataFrame([(1, 1, None), (None, 0, 1), (6, 1, 1), (8, 1, 0), (8, 1, 0), (99, 1, 1), (9, 0, 0), (10, 0, 1)], schema)
    model = T.train(odd, labels)
    got = T.score(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    blank = {r["score"] for r in got if r["doc_id"] in (1, 2, 3)}
    assert len(blank) == 1
    assert T.score(empty, model).count() == 0
    none = T.train(odd, labels.limit(0))
    assert {round(r["score"]) for r in T.score(odd, none).collect()} == {0}
    assert T.clean_documents(odd, none).count() == len(ODD)


def test_whole_table(spark):
    got = T.op9_toxicity(spark, SF01).collect()
    assert len(got) == table(spark, SF01, "documents").count()
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF01, "labels").collect()}
    held = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert sum(p == y for p, y in held) >= 0.85 * len(held)
