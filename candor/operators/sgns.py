"""Trained item vectors: negative sampling over co-occurrence counts, in rotating blocks.

Every item has an input vector and a context vector. Training raises sigma(input . context) of items seen
near each other and lowers it for ``negative`` contexts drawn at random, as word2vec does. Pairs are counted
before (``embed.cooccurrence``: they add up over days), and a pair counts as often as it occurred, frequent
items thinned out by ``sample``.

Vectors are a table, never a matrix on the driver. Items and contexts are dealt to B blocks of about
``BLOCK`` by a hash; a pass is B rotations, in rotation r the task of block b holds the inputs of block b, the contexts of
block (b + r) mod B and the counts between them, so tasks share no vector and run at the same time without locks. Each rotation's vectors
are set down: an executor that is lost costs one rotation of one block. Steps inside a task are numpy mini-batches in an
order drawn from (seed, pass, blocks) over sorted pairs, so the result doesn't depend on partitioning.

Warm start. ``start`` gives yesterday's vectors: items in it begin where they were, new items at the weighted mean of
their known contexts' inputs (or at random without any), so the vocabulary grows and old ids keep their places; items without counts today
are carried over untrained.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..session import set_down
from .embed import sign_bits

BLOCK = 20_000  # items of a block: two matrices of 100 doubles are 32 MB
BATCH = 64
DRAWN = 256  # batches whose negatives are drawn at once
FACTORS = "item string, block long, vin array<double>, vctx array<double>"


def _blocks(n_items: int, block: int) -> int:
    return max(1, -(-n_items // block))


def _block_of(column: str, blocks: int):
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("long")


def started(counts: DataFrame, size: int, blocks: int, start: DataFrame | None) -> DataFrame:
    """Vectors before training: (item, block, vin, vctx) of every item of the counts and of ``start``."""
    items = counts.select("item").distinct()
    fresh = F.transform(sign_bits(F.col("item"), size), lambda s: s * (0.5 / size))  # fixed by the id
    zero = F.array_repeat(F.lit(0.0), size)
    if start is None:
        return items.select("item", _block_of("item", blocks).alias("block"), fresh.alias("vin"), zero.alias("vctx"))
    old = start.select(F.col("item").alias("o_item"), F.col("vin").alias("o_vin"), F.col("vctx").alias("o_vctx"))
    new = items.join(old, F.col("item") == F.col("o_item"), "left_anti")
    near = counts.join(new.withColumnRenamed("item", "n_item"), F.col("item") == F.col("n_item"), "left_semi")
    near = near.join(old, F.col("ctx") == F.col("o_item"))
    mean = near.groupBy(F.col("item").alias("m_item")).agg(F.array(*[F.sum(F.col("n") * F.col("o_vin")[j]) / F.sum("n") for j in range(size)]).alias("mean"))
    new = new.join(mean, F.col("item") == F.col("m_item"), "left").select("item", F.coalesce("mean", fresh).alias("vin"), zero.alias("vctx"))
    every = new.unionByName(old.select(F.col("o_item").alias("item"), F.col("o_vin").alias("vin"), F.col("o_vctx").alias("vctx")))
    return every.select("item", _block_of("item", blocks).alias("block"), "vin", "vctx")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def trained_block(a: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray, w: np.ndarray, often: np.ndarray, *,
                  rate: float, negative: int, rng: np.random.Generator) -> float:
    """One pass over pairs (i, j) with weights ``w``: inputs ``a`` and contexts ``c`` change in place; returns the summed loss.

    ``often``: weight of every context as a negative. Weights above 1 are taken as that many repeats of the pair.
    """
    if not (a.flags.c_contiguous and c.flags.c_contiguous):
        raise ValueError("inputs and contexts must be contiguous: they change through flat views")
    repeats = np.floor(w + rng.random(len(w))).astype(np.int64)
    at = np.repeat(np.arange(len(w)), repeats)
    rng.shuffle(at)
    p = np.cumsum(often / often.sum())
    size, width = a.shape[1], negative + 1
    # sums by row number go element by element into flat views: numpy's indexed add is many times slower on whole rows
    flat_a, flat_c, column = a.reshape(-1), c.reshape(-1), np.arange(size)
    v, step = np.empty((BATCH, width, size)), np.empty((BATCH, width, size))
    place, place_a, back = np.empty((BATCH, width, size), np.int64), np.empty((BATCH, size), np.int64), np.empty((BATCH, size))
    loss = 0.0
    for begin in range(0, len(at), BATCH * DRAWN):
        some = at[begin:begin + BATCH * DRAWN]
        xs, ys = i[some], j[some]
        nos = np.minimum(np.searchsorted(p, rng.random((len(some), negative))), len(c) - 1)
        targets = np.column_stack([ys, nos])
        skip = nos == ys[:, None]  # a negative that is the pair's own context says nothing
        sign = np.zeros(targets.shape)
        sign[:, 0] = 1
        rates = np.full(targets.shape, rate)
        rates[:, 1:][skip] = 0
        got = np.empty(targets.shape)
        for k in range(0, len(some), BATCH):
            x, target, y = xs[k:k + BATCH], targets[k:k + BATCH], got[k:k + BATCH]
            n = len(x)
            u = a[x]
            np.take(c, target, axis=0, out=v[:n], mode="clip")
            y[:] = _sigmoid(np.einsum("bd,bkd->bk", u, v[:n]))
            g = rates[k:k + BATCH] * (sign[k:k + BATCH] - y)
            np.einsum("bk,bkd->bd", g, v[:n], out=back[:n])
            np.multiply(g[:, :, None], u[:, None, :], out=step[:n])
            np.add((target * size)[:, :, None], column, out=place[:n])
            np.add((x * size)[:, None], column, out=place_a[:n])
            np.add.at(flat_a, place_a[:n].reshape(-1), back[:n].reshape(-1))
            np.add.at(flat_c, place[:n].reshape(-1), step[:n].reshape(-1))
        loss -= np.log(got[:, 0] + 1e-12).sum() + (np.log(1 - got[:, 1:] + 1e-12) * ~skip).sum()
    return float(loss)


def train(
    counts: DataFrame, *, size: int = C.W2V_SIZE, epochs: int = C.W2V_EPOCHS, negative: int = 5, sample: float = 1e-3,
    rate: float = 0.05, seed: int = 42, block: int = BLOCK, start: DataFrame | None = None,
) -> tuple[DataFrame, list[float]]:
    """Co-occurrence counts (item, ctx, n) -> vectors (item, vin, vctx), and the mean loss a pair of every pass.

    ``start``: the vectors of an earlier call. Rates fall linearly over the passes.
    """
    counts = set_down(counts.select("item", "ctx", F.col("n").cast("double")))
    totals = set_down(counts.groupBy("item").agg(F.sum("n").alias("total")))
    s = totals.agg(F.count(F.lit(1)).alias("items"), F.sum("total").alias("total")).first()
    known = 0 if start is None else start.count()
    if not s["items"]:
        none = counts.sparkSession.createDataFrame([], "item string, vin array<double>, vctx array<double>")
        return (none if start is None else start.select("item", "vin", "vctx")), []
    blocks = _blocks(s["items"] + known, block)
    # frequent items are thinned as word2vec does: the share kept falls with the root of the frequency
    f = F.col("total") / F.lit(float(s["total"]))
    kept = totals.select(F.col("item").alias("t_item"), "total", F.least(F.lit(1.0), F.sqrt(F.lit(sample) / f) + F.lit(sample) / f).alias("kept"))
    pairs = counts.join(kept, F.col("item") == F.col("t_item")).select("item", "ctx", "n", F.col("kept").alias("k_item"))
    pairs = pairs.join(kept, F.col("ctx") == F.col("t_item")).select(
        "item", "ctx", (F.col("n") * F.col("k_item") * F.col("kept")).alias("w"), _block_of("item", blocks).alias("a"), _block_of("ctx", blocks).alias("c"))
    pairs = set_down(pairs)
    often = totals.select(F.col("item").alias("o_item"), F.pow("total", F.lit(0.75)).alias("often"))
    vectors = started(counts, size, blocks, start).join(often, F.col("item") == F.col("o_item"), "left").select(
        "item", "block", "vin", "vctx", F.coalesce("often", F.lit(0.0)).alias("often"))
    vectors, losses = set_down(vectors), []
    out = "kind string, item string, vec array<double>, often double, loss double, n double"

    def rotation(epoch: int, turn: int, now: float):
        def run(key: tuple, p: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
            v = v.sort_values("item", kind="stable")
            ins, ctxs = v[v["kind"] == "in"], v[v["kind"] == "ctx"]
            a = np.vstack(ins["vec"].to_numpy()) if len(ins) else np.zeros((0, size))
            c = np.vstack(ctxs["vec"].to_numpy()) if len(ctxs) else np.zeros((0, size))
            loss = n = 0.0
            weights = ctxs["often"].to_numpy(np.float64)
            if len(p) and weights.sum() > 0:
                p = p.sort_values(["item", "ctx"], kind="stable")
                i, j = np.searchsorted(ins["item"].to_numpy(str), p["item"].to_numpy(str)), np.searchsorted(ctxs["item"].to_numpy(str), p["ctx"].to_numpy(str))
                w = p["w"].to_numpy(np.float64)
                loss, n = trained_block(a, c, i, j, w, weights, rate=now, negative=negative, rng=np.random.default_rng([seed, epoch, turn, int(key[0])])), float(w.sum())
            rows = pd.concat([ins, ctxs], ignore_index=True)[["kind", "item", "often"]].assign(vec=[*a, *c], loss=0.0, n=0.0)
            rows.loc[rows.index[:1], ["loss", "n"]] = loss, n
            return rows[["kind", "item", "vec", "often", "loss", "n"]]

        return run

    for epoch in range(epochs):
        lost = n = 0.0
        for turn in range(blocks):
            now = rate * max(0.05, 1 - (epoch * blocks + turn) / (epochs * blocks))
            own = F.pmod(F.col("block") - F.lit(turn), F.lit(blocks))  # the task that holds a block's contexts
            sides = vectors.select(F.explode(F.array(
                F.struct(F.lit("in").alias("kind"), F.col("block").alias("task"), F.col("vin").alias("vec")),
                F.struct(F.lit("ctx").alias("kind"), own.alias("task"), F.col("vctx").alias("vec")))).alias("x"), "item", "often")
            sides = sides.select("x.kind", "x.task", "x.vec", "item", "often")
            here = pairs.where(F.pmod(F.col("c") - F.col("a"), F.lit(blocks)) == turn).select(F.col("a").alias("task"), "item", "ctx", "w")
            done = set_down(here.groupBy("task").cogroup(sides.groupBy("task")).applyInPandas(rotation(epoch, turn, now), out))
            told = done.agg(F.sum("loss").alias("loss"), F.sum("n").alias("n")).first()
            lost, n = lost + told["loss"], n + told["n"]
            vectors = done.groupBy("item").agg(
                F.max(F.when(F.col("kind") == "in", F.col("vec"))).alias("vin"), F.max(F.when(F.col("kind") == "ctx", F.col("vec"))).alias("vctx"),
                F.max("often").alias("often")).withColumn("block", _block_of("item", blocks))
        losses.append(lost / n if n else 0.0)
    return set_down(vectors.select("item", "vin", "vctx")), losses


def item_vectors(vectors: DataFrame) -> DataFrame:
    """(item, vin, ...) -> (pid, vector): the inputs of digit ids."""
    return vectors.where(F.col("item").rlike("^[0-9]+$")).select(F.col("item").cast("bigint").alias("pid"), F.col("vin").alias("vector"))


def next_item_hits(sequences: DataFrame, vectors: DataFrame, *, items_col: str = "items", last: int = 3, k: int = 10) -> DataFrame:
    """How often the item that ends a sentence is among the ``k`` items nearest to the mean of the ``last`` before it:
    one row (sentences, hits, rate). Sentences whose context has no vector count as misses.

    ``vectors``: (pid, vector). The search is the forest's; items of the context itself are left out.
    """
    from .forest import knn_forest

    s = sequences.where(F.size(items_col) > last).select(F.monotonically_increasing_id().alias("pid"), F.col(items_col).alias("items"))
    s = set_down(s.select("pid", F.element_at("items", -1).cast("bigint").alias("goal"), F.transform(F.slice("items", -1 - last, last), lambda x: x.cast("bigint")).alias("seen")))
    v = vectors.select(F.col("pid").alias("v_pid"), "vector")
    x = s.select("pid", F.explode("seen").alias("of")).join(v, F.col("of") == F.col("v_pid")).select("pid", F.posexplode("vector").alias("d", "x"))
    x = x.groupBy("pid", "d").agg(F.avg("x").alias("x")).groupBy("pid").agg(F.sort_array(F.collect_list(F.struct("d", "x"))).alias("v"))
    near = knn_forest(x.select("pid", F.transform("v", lambda e: e["x"]).alias("vector")), k=k + last, min_score=-1.0, others=vectors)
    near = near.join(s.select(F.col("pid").alias("s_pid"), "seen"), F.col("pid") == F.col("s_pid")).where(~F.array_contains("seen", F.col("near_pid")))
    best = near.groupBy("pid").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "near_pid"))), 1, k).alias("b"))
    hit = s.join(best.select(F.col("pid").alias("b_pid"), F.col("b.near_pid").alias("b")), F.col("pid") == F.col("b_pid"), "left")
    hits = F.sum(F.coalesce(F.array_contains("b", F.col("goal")), F.lit(False)).cast("long"))
    return hit.agg(F.count(F.lit(1)).alias("sentences"), F.coalesce(hits, F.lit(0)).alias("hits")).withColumn(
        "rate", F.when(F.col("sentences") > 0, F.col("hits") / F.col("sentences")))
