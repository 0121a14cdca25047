"""Weak supervision: measures against plain Python, EM against known accuracies, the labelled documents."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from candor.llm import weak_rules as W
from candor.sources.tables import table
from llm_data import ODD, SF01, docs_of

SPACE = " \t\n\v\f\r"


def measures(text):
    text = text or ""
    words = re.findall(r"[^ \t\n\v\f\r]+", text)
    grams = list(zip(words, words[1:], words[2:]))
    count = {}
    for g in grams:
        count[g] = count.get(g, 0) + 1
    covered = {k for i, g in enumerate(grams) if count[g] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


MORE = [(20, "a b c a b c d", "a"), (21, "x x x x", "a"), (22, "a b c\nd\na b c\n \nd\n", "b"), (23, "# * $ % & | < >\t\v\f\r\n", "b"), (24, "\x1c\x85  a\xa0b", "b"),
        (25, "w " * 60 + "end", "c"), (26, "𝒳𝒴 é́ ß", "c"), (27, "a b a b a b", None), (28, "One. Two! Three? ", "d")]


@pytest.mark.parametrize("rows", [ODD + MORE, []], ids=["odd", "empty"])
def test_measures(spark, rows):
    got = W.judged(docs_of(spark, rows)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    want = sorted([(-1 if i is None else i, *measures(t)) for i, t, _ in rows])
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], *(r[c] for c in names)) for r in got) == want
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["posterior"] >= 0.5)
        if not r["n_words"]:
            assert all(r[v] == 0 for v in W.VOTES)


def test_em_finds_the_accuracies(spark):
    rng = np.random.default_rng(4)
    n, good = 40_000, 0.85
    y = rng.random(n) < good
    shares = {v: ((0.9 - 0.05 * k % 0.2, 0.03, 0.07 + 0.05 * k % 0.2), (0.1, 0.6, 0.3)) for k, v in enumerate(W.VOTES)}
    votes = {v: np.where(y, rng.choice([1, -1, 0], n, p=np.array(a) / sum(a)), rng.choice([1, -1, 0], n, p=b)) for v, (a, b) in shares.items()}
    import pandas as pd

    frame = pd.DataFrame(votes).value_counts().reset_index(name="n")
    prior, model = W.fitted(spark.createDataFrame(frame))
    assert abs(prior - y.mean()) < 0.01
    for v in W.VOTES:
        for vote in (1, -1, 0):
            for k, of in enumerate((y, ~y)):
                assert abs(model[v][vote][k] - (votes[v][of] == vote).mean()) < 0.02


def test_empty_patterns_leave_the_start(spark):
    none = spark.createDataFrame([], ", ".join(f"{v} int" for v in W.VOTES) + ", n bigint")
    assert W.fitted(none) == (W.PRIOR, {v: W.START for v in W.VOTES})


def test_labelled_documents(spark):
    got = W.judged(table(spark, SF01, "documents")).where("not base_failed").join(table(spark, SF01, "labels"), "doc_id")
    kept = {r["quality"]: (r["kept"], r["n"]) for r in got.groupBy("quality").agg(F.sum(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()}
    assert kept[1][0] >= 0.99 * kept[1][1] and kept[0][0] <= 0.05 * kept[0][1]


def test_runs_no_python(spark):
    plan = W.judged(table(spark, SF01, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapPartitions", plan)
