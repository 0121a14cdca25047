"""BagMinHash: unbiased signatures, exact classes against all pairs, rounds, odd rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from candor.llm import bagminhash as B
from candor.sources.tables import table
from llm_data import ODD, SF01, docs_of


def bag(text):
    w = (text or "").lower().split()
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def similarity(a, b):
    if len(a) == 0 or len(b) == 0 or len(next(iter(a))) != len(next(iter(b))):
        return 0.0
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def brute_classes(rows, threshold=0.8):
    """Connected classes of all pairs by exact overlap; equal word lists are one class."""
    bags = [bag(t) for _, t, *_ in rows]
    words = [tuple((t or "").lower().split()) for _, t, *_ in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    held = defaultdict(list)
    for i, b in enumerate(bags):
        for j in {j for s in b for j in held[s]}:
            if similarity(b, bags[j]) >= threshold:
                up[top(i)] = top(j)
        for s in b:
            held[s].append(i)
    first = {}
    for i, w in enumerate(words):
        up[top(i)] = top(first.setdefault(w, i))
    classes = defaultdict(list)
    for i in range(len(rows)):
        classes[top(i)].append(rows[i][0])
    return sorted((max((d for d in c if d is not None), default=-1), len(c)) for c in classes.values())


def classes_of(docs):
    got = B.near_duplicates(docs).collect()
    out, kept = Counter(), Counter()
    for r in got:
        key = (r["class_id"], r["class_rid"], r["class_size"])
        out[key] += 1
        kept[key] += r["kept"]
    assert all(n == key[2] for key, n in out.items()) and set(kept.values()) <= {1}
    return sorted((-1 if i is None else i, n) for i, _, n in out)


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    ids = np.arange(60, dtype=np.uint64) * np.uint64(7919)
    a = rng.integers(0, 9, 60)
    b = np.maximum(0, a + rng.integers(-3, 4, 60))
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    m, got = 4000, None
    s = B.signatures([(ids[a > 0], a[a > 0]), (ids[b > 0], b[b > 0])], components=m)
    got = (s[0] == s[1]).mean()
    assert abs(got - want) < 4 * (want * (1 - want) / m) ** 0.5
    # a bag's signature doesn't depend on what it is worked out with
    assert (B.signatures([(ids[a > 0], a[a > 0])], components=m)[0] == s[0]).all()


def test_overlap_counts_repeats():
    h = B._WordHash()
    a, b = "x y z w v " * 4 + "q", "x y z w v " * 6 + "q"
    got = B.overlap(B.shingles(a.split(), h), B.shingles(b.split(), h))
    assert got == pytest.approx(similarity(bag(a), bag(b)))


def test_odd_rows(spark, odd, empty):
    assert classes_of(odd) == brute_classes(ODD)
    assert B.near_duplicates(empty).count() == 0
    assert B.one_of_each(odd).columns == odd.columns
    assert B.one_of_each(odd).count() == len(brute_classes(ODD))


def changed(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_whose_members_are_near_to_some_only(spark):
    # copies with so many changes that their similarities lie on both sides of the threshold
    rng = random.Random(5)
    rows, i = [], 0
    for g in range(6):
        base = [f"g{g}w{k}" for k in range(200)]
        for _ in range(14):
            rows.append((i, changed(rng, base, rng.randrange(0, 9)), "a"))
            i += 1
    for k in range(40):
        rows.append((i, " ".join(f"u{k}v{j}" for j in range(rng.randrange(3, 60))), "b"))
        i += 1
    assert classes_of(docs_of(spark, rows)) == brute_classes(rows)


def test_chains(spark):
    # each text is near to the next alone
    words = [f"c{k}" for k in range(260)]
    rows = [(k, " ".join(words[8 * k:8 * k + 120]), "a") for k in range(16)]
    assert len(brute_classes(rows)) == 1
    assert classes_of(docs_of(spark, rows)) == brute_classes(rows)


def test_whole_table(spark):
    docs = table(spark, SF01, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert classes_of(docs) == brute_classes(rows)


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 120)] + [(200, 201)]
    got = dict(map(tuple, B.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 120)}, 200: 200, 201: 200}


def test_a_common_passage_and_a_large_group_of_edited_copies(spark, monkeypatch):
    """Texts alike through one passage, and copies with few edited words: all links, by few comparisons."""
    rng = np.random.default_rng(11)
    words = [f"w{k}" for k in range(3000)]
    passage, base = list(rng.choice(words, 60)), list(rng.choice(words, 150))
    texts = [list(rng.choice(words, 25)) + passage + list(rng.choice(words, 10)) for _ in range(150)]
    for _ in range(250):
        copy = list(base)
        for at in rng.choice(len(base), rng.integers(0, 7), replace=False):
            copy[at] = str(rng.choice(words))
        texts.append(copy)
    texts = [" ".join(t) for t in texts]
    compared, real = [], B.compared

    def counted(pairs, docs):
        out = real(pairs, docs)
        compared.append(out.count())
        return out

    monkeypatch.setattr(B, "compared", counted)
    rows = list(enumerate(texts))
    assert classes_of(spark.createDataFrame(rows, "doc_id long, text string")) == brute_classes(rows)
    assert sum(compared) < len(texts) * (len(texts) - 1) / 2 / 10
