"""Toxicity: averaged subword embeddings under a linear softmax, trained jointly in numpy.

A word is the bag of itself and its character n-grams (3 to 5, with word boundaries), hashed to
buckets. A document is the mean of its words' subword embeddings; a linear softmax over that mean gives
its score. Embeddings and softmax are fitted together, so a misspelling that training never saw
still finds the n-grams it shares with words that training saw.

The model is fitted in one task on at most ``max_docs`` labelled documents (up to half of them
toxic; those with the smallest hash of their id) weighted back to the labels' true
shares. Every document is then scored whole, where it lies: after training, a softmax over a mean is a
mean of one number a bucket, which is what the executors get (``BUCKETS`` floats).

Defined results: null and empty texts have no words and score the bias alone; a null doc_id counts as
held out; labels that are null or lack a document are passed over; without labels of both classes
the score is the share of toxic labels (0 without any); repeated rows score alike; an empty table
gives no rows. Inputs are read by name, so further columns can have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import decided, require, stored, table, with_row_id

BUCKETS = 1 << 17
GRAMS = (3, 4, 5)
EDGES = ".,;:!?\"'()[]{}<>*%#$&|-_/\\"  # stripped from a word's ends
CACHE = 300_000  # words that a task keeps; then it starts afresh


def subwords(word: str) -> list[int]:
    """Buckets of a word and of its character 3- to 5-grams; none for a word of mere punctuation."""
    word = word.lower().strip(EDGES)
    if not word:
        return []
    w = f"<{word}>"
    grams = [w, *(w[i:i + n] for n in GRAMS if n < len(w) for i in range(len(w) - n + 1))]
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) & (BUCKETS - 1) for g in grams]


def n_subwords(word: str) -> int:
    """``len(subwords(word))`` without making them."""
    n = len(word.lower().strip(EDGES)) + 2
    return 1 + sum(n - k + 1 for k in GRAMS if k < n) if n > 2 else 0


@dataclass
class Model:
    """A softmax over the mean embedding, folded: one logit for each bucket, and the bias."""

    logits: np.ndarray
    bias: float

    def score(self, total: np.ndarray, number: np.ndarray) -> np.ndarray:
        z = self.bias + total / np.maximum(number, 1)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


class _Sparse:
    """A sparse matrix as (row, column, value) triples, with products from either side."""

    def __init__(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, shape: tuple[int, int]):
        self.shape, self.sides = shape, []
        for own, other, n in ((row, col, shape[0]), (col, row, shape[1])):
            order = np.argsort(own, kind="stable")
            at, starts = np.unique(own[order], return_index=True)
            self.sides.append((at, starts, other[order], value[order].astype(np.float32)[:, None], n))

    def _times(self, side: int, x: np.ndarray) -> np.ndarray:
        at, starts, other, value, n = self.sides[side]
        out = np.zeros((n, x.shape[1]), np.float32)
        if len(at):
            out[at] = np.add.reduceat(x[other] * value, starts, axis=0)
        return out

    def dot(self, x: np.ndarray) -> np.ndarray:
        return self._times(0, x)

    def t_dot(self, x: np.ndarray) -> np.ndarray:
        return self._times(1, x)


def _bags(texts: list[str | None], min_docs: int) -> tuple[_Sparse, _Sparse]:
    """Documents as shares of words (each word's count over the document's number of subwords), and words
    as counts of buckets. Words in fewer than ``min_docs`` documents are in the shares' divisor only."""
    ids: dict[str, int] = {}
    sizes: list[int] = []
    parts: list[tuple[np.ndarray, ...]] = []
    for d, text in enumerate(texts):
        own: dict[int, int] = {}
        for raw in (text or "").split():
            k = ids.get(raw)
            if k is None:
                k = ids[raw] = len(sizes)
                sizes.append(n_subwords(raw))
            own[k] = own.get(k, 0) + 1
        number = max(1, sum(n * sizes[k] for k, n in own.items()))
        own = {k: n for k, n in own.items() if sizes[k]}
        word = np.fromiter(own.keys(), np.int32, len(own))
        parts.append((np.full(len(own), d, np.int32), word, np.fromiter(own.values(), np.float32, len(own)) / number))
    doc, word, share = (np.concatenate([p[i] for p in parts]) for i in range(3))
    often = np.bincount(word, minlength=len(sizes)) >= min_docs
    on = often[word] if len(word) else np.zeros(0, bool)
    new = (np.cumsum(often) - 1).astype(np.int32)
    bags = [np.array(subwords(raw), np.int32) for raw, k in ids.items() if often[k]]
    of = np.repeat(np.arange(len(bags), dtype=np.int32), [len(b) for b in bags])
    buckets = np.concatenate([np.zeros(0, np.int32), *bags])
    return (_Sparse(doc[on], new[word[on]], share[on], (len(texts), len(bags))),
            _Sparse(of, buckets, np.ones(len(of), np.float32), (len(bags), BUCKETS)))


def fit(texts: list[str | None], toxic: np.ndarray, weight: np.ndarray, dim: int = 4, epochs: int = 60,
        rate: float = 1.0, decay: float = 1e-7, min_docs: int = 2, seed: int = 1) -> Model:
    """Fit embeddings and softmax together by Adam over all of the sample in each step."""
    shares, grams = _bags(texts, min_docs)
    y = toxic.astype(np.float32)
    weight = (weight / weight.sum()).astype(np.float32)
    rng = np.random.default_rng(seed)
    prior = float((weight * y).sum())
    params = [np.zeros((BUCKETS, dim), np.float32), rng.normal(0, 1, (dim, 2)).astype(np.float32),
              np.array([0.0, np.log(prior / (1 - prior))], np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    rates = (rate, 0.02, 0.05)
    for step in range(1, epochs + 1):
        hidden = shares.dot(grams.dot(params[0]))
        z = hidden @ params[1] + params[2]
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = (p - np.stack([1 - y, y], 1)) * weight[:, None]
        grads = [grams.t_dot(shares.t_dot(g @ params[1].T)) + decay * params[0], hidden.T @ g, g.sum(0)]
        for i, d in enumerate(grads):
            m, v = moments[i]
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            params[i] -= rates[i] * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    out = params[1][:, 1] - params[1][:, 0]
    return Model((params[0] @ out).astype(np.float32), float(params[2][1] - params[2][0]))


def held_out(doc_id) -> F.Column:
    """True for the ids that training must not see: crc32 of the id as text divides by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 6000) -> Model:
    """The model of the training part of ``labels``, fitted on at most ``max_docs`` documents."""
    marks = require(labels, ["doc_id", "toxic"]).where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    n = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    if not (n.get(0) and n.get(1)):
        return Model(np.zeros(BUCKETS, np.float32), 500.0 if n.get(1) else -500.0)
    order = F.xxhash64("doc_id")
    share = {1: min(n[1], max_docs // 2)}
    share[0] = max_docs - share[1]
    picked = [marks.where(F.col("toxic") == k).orderBy(order, "doc_id").limit(share[k]) for k in (0, 1)]
    # at most max_docs rows, so it is right to send them to every task
    picked = F.broadcast(picked[0].unionByName(picked[1]))
    sample = require(docs, ["doc_id", "text"]).join(picked, "doc_id").select("doc_id", "text", "toxic")

    def fitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "toxic": []}), *batches])
        got = got.sort_values(["doc_id", "text", "toxic"], ignore_index=True)
        toxic = got["toxic"].to_numpy(np.int64)
        if len(set(toxic)) < 2:
            model = Model(np.zeros(BUCKETS, np.float32), 500.0 if toxic.any() else -500.0)
        else:
            weight = np.where(toxic == 1, n[1] / (toxic == 1).sum(), n[0] / (toxic == 0).sum())
            model = fit(got["text"].tolist(), toxic, weight)
        yield pd.DataFrame({"logits": [model.logits.tobytes()], "bias": [model.bias]})

    # one task on purpose: the sample's bound is max_docs, whatever the table's size
    out = sample.repartition(1).mapInPandas(fitted, "logits binary, bias double").first()
    return Model(np.frombuffer(out["logits"], np.float32), out["bias"])


class _Words(dict):
    """Word -> its row in ``parts`` (summed logit, number of subwords), worked out when first met."""

    def __init__(self, logits: np.ndarray):
        super().__init__()
        self.logits, self.parts = logits, []

    def __missing__(self, word: str) -> int:
        grams = subwords(word)
        self.parts.append((float(self.logits[grams].sum()) if grams else 0.0, len(grams)))
        self[word] = n = len(self.parts) - 1
        return n


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, rid and score of every document; no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        words = _Words(model.logits)
        for batch in batches:
            if len(words) > CACHE:
                words = _Words(model.logits)
            rows = [[words[w] for w in (text or "").split()] for text in batch["text"]]
            parts = np.array(words.parts or [(0.0, 0)])
            sums = np.array([parts[r].sum(0) if r else (0.0, 0.0) for r in rows]).reshape(-1, 2)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "rid": batch["rid"], "score": model.score(sums[:, 0], sums[:, 1])})

    rows = with_row_id(require(docs, ["doc_id", "text"])).select("row.doc_id", "rid", "row.text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(part, f"doc_id {kind}, rid bigint, score double")


def clean_documents(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs``, all columns kept, without those that score ``threshold`` or more."""
    docs = stored(docs)
    return decided(with_row_id(docs), score(docs, model).where(F.col("score") < threshold), "doc_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
