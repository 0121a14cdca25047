"""Approximate nearest neighbours by a forest of random-projection trees.

Every tree cuts the vectors in two, level by level, by their projections on a direction through two vectors picked
at random: of a few such directions it takes the one with the thinnest place near the middle and cuts there, so clusters
mostly stay together, and where one tree separates two vectors another doesn't. A search
compares a vector with those in its own leaf of each tree: ``trees * leaf`` vectors, however many there are.

* The first levels (up to ``MAX_DEPTH``) are learned on a bounded sample of items, those with the
  smallest hashes, and their planes broadcast: at most ``trees * 2 ** MAX_DEPTH`` of them, whatever the table's size.
* Leaves that still hold more than twice ``leaf`` items are cut on by Spark, all at once and a level a round:
  projections on fixed sign vectors, medians by ``percentile_approx`` per leaf. What lies on
  the median (copies of one vector) is halved by a hash, so every leaf ends bounded.
* Leaves are scored as blocks (``operators.meet``); a table that fits one leaf is searched exactly.

Recall depends on the vectors: see ``knn_recall`` and the README's figures.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import set_down
from .embed import signs_of
from .knn import unit_vectors
from .meet import met

TREES, LEAF = 6, 512
SAMPLE, MAX_DEPTH, TRIES = 20_000, 10, 12
ROUTED = "pid long, vec array<double>, item boolean, groups array<long>"


def _cut(p: np.ndarray) -> tuple[float, float]:
    """A threshold in the middle third of projections ``p`` where they lie thinnest, and how thin that is."""
    p = np.sort(p)
    n, w = len(p), max(1, len(p) // 50)
    low, high = max(0, n // 3 - w), min(n - w, n - n // 3)
    if high <= low or p[-1] <= p[0]:
        return float(p[n // 2]), 0.0
    gaps = p[low + w:high + w] - p[low:high]  # widths that hold w projections each
    at = int(np.argmax(gaps))
    return float(p[low + at:low + at + w + 1].mean()), float(gaps[at] * n / w / (p[-1] - p[0]))


def learned(sample: np.ndarray, trees: int, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (tree, node, dim) and thresholds (tree, node) of ``depth`` levels; children of node i are 2i + 1 and 2i + 2.

    Of ``TRIES`` random directions a node takes the one that can be cut in the thinnest place.
    """
    rng = np.random.default_rng(seed)
    nodes = 2**depth - 1
    planes, cuts = np.zeros((trees, nodes, sample.shape[1])), np.zeros((trees, nodes))
    for t in range(trees):
        held = {0: np.arange(len(sample))}
        for node in range(nodes):
            rows = held.pop(node)
            if len(rows) > 1:
                pairs = rng.choice(rows, (TRIES, 2))
                tried = sample[pairs[:, 0]] - sample[pairs[:, 1]]
                found = [_cut(p) for p in (sample[rows] @ tried.T).T]
                best = max(range(TRIES), key=lambda k: found[k][1])
                planes[t, node], cuts[t, node] = tried[best], found[best][0]
            if not planes[t, node].any():  # copies, or nothing left of the sample: any direction
                planes[t, node] = rng.normal(size=sample.shape[1])
                cuts[t, node] = np.median(sample[rows] @ planes[t, node]) if len(rows) else 0.0
            side = sample[rows] @ planes[t, node] >= cuts[t, node]
            held[2 * node + 1], held[2 * node + 2] = rows[~side], rows[side]
    return planes, cuts


def leaves(x: np.ndarray, planes: np.ndarray, cuts: np.ndarray, depth: int) -> np.ndarray:
    """The leaf of every row in every tree (row, tree)."""
    out = np.zeros((len(x), len(planes)), np.int64)
    for t in range(len(planes)):
        node = out[:, t]
        for _ in range(depth):
            node = 2 * node + 1 + (np.einsum("ij,ij->i", x, planes[t, node]) >= cuts[t, node])
        out[:, t] = node
    return out


def _cut_on(rows: DataFrame, trees: int, leaf: int, dim: int) -> DataFrame:
    """``rows``, set down, with groups cut on until none holds more than ``2 * leaf`` items.

    Only vectors in groups that are too big travel; a row's new leaves are joined back by its position.
    """
    # few rows, at most one for every 2 * leaf items of a tree: broadcast, so what lies elsewhere is never shuffled
    def too_big(long: DataFrame) -> DataFrame | None:
        n = long.where("item").groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * leaf)
        n = set_down(n.select(F.col("tree").alias("b_tree"), F.col("leaf").alias("b_leaf")))
        return n if n.limit(1).count() else None

    rows = rows.withColumn("at", F.monotonically_increasing_id())
    long = rows.select("at", "pid", "vec", "item", F.posexplode("groups").alias("tree", "leaf"))
    big, level, done = too_big(long), 0, None
    if big is None:
        return rows.drop("at")
    at = (F.col("tree") == F.col("b_tree")) & (F.col("leaf") == F.col("b_leaf"))
    while big is not None:
        signs = F.array(*[F.array(*[F.lit(float(s)) for s in signs_of(f"tree {t} level {level}", dim)]) for t in range(trees)])
        p = F.aggregate(F.zip_with("vec", F.get(signs, F.col("tree")), lambda x, s: x * s), F.lit(0.0), lambda a, x: a + x)
        if done is not None:
            done.append(long.join(F.broadcast(big), at, "left_anti").select("at", "tree", "leaf"))
        own = set_down(long.join(F.broadcast(big), at).drop("b_tree", "b_leaf").withColumn("p", p))
        middle = own.where("item").groupBy(F.col("tree").alias("b_tree"), F.col("leaf").alias("b_leaf")).agg(F.percentile_approx("p", 0.5, 10_000).alias("middle"))
        tie = F.pmod(F.xxhash64("pid", F.lit(level)), F.lit(2))
        side = F.when(F.col("p") < F.col("middle"), 0).when(F.col("p") > F.col("middle"), 1).otherwise(tie)
        long = own.join(F.broadcast(middle), at).select("at", "pid", "vec", "item", "tree", F.xxhash64("leaf", F.lit(level), side).alias("leaf"))
        done, long = done or [], set_down(long)
        big, level = too_big(long), level + 1
    done.append(long.select("at", "tree", "leaf"))
    moved = done[0]
    for d in done[1:]:
        moved = moved.unionByName(d)
    moved = moved.groupBy(F.col("at").alias("m_at")).agg(F.map_from_entries(F.collect_list(F.struct("tree", "leaf"))).alias("m"))
    groups = F.transform("groups", lambda g, t: F.coalesce(F.try_element_at("m", t), g))
    return rows.join(moved, F.col("at") == F.col("m_at"), "left").select("pid", "vec", "item", groups.alias("groups"))


def routed(vectors: DataFrame, *, trees: int = TREES, leaf: int = LEAF, seed: int = 42, sample: int = SAMPLE) -> DataFrame:
    """(pid, vec, item) -> the same with ``groups``, the leaf in every tree; trees are made of the items alone."""
    items = vectors.where("item")
    picked = items.orderBy(F.xxhash64("pid"), "pid").limit(sample).select("vec").toPandas()["vec"].tolist()  # bounded by ``sample``
    if not picked:
        return vectors.withColumn("groups", F.array_repeat(F.lit(0).cast("long"), trees))
    n = len(picked) if len(picked) < sample else items.count()
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(n / leaf)))))
    model = vectors.sparkSession.sparkContext.broadcast(learned(np.array(picked), trees, depth, seed))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes, cuts = model.value
        for batch in batches:
            if len(batch):
                yield batch.assign(groups=list(leaves(np.vstack(batch["vec"].to_numpy()), planes, cuts, depth)))

    rows = set_down(vectors.select("pid", "vec", "item").mapInPandas(route, ROUTED))
    return _cut_on(rows, trees, leaf, len(picked[0]))


def knn_forest(
    vectors: DataFrame, *, k: int = 200, min_score: float = 0.5, id_col: str = "pid", vec_col: str = "vector",
    trees: int = TREES, leaf: int = LEAF, seed: int = 42, others: DataFrame | None = None,
) -> DataFrame:
    """Approximate top-``k`` neighbours with cosine >= ``min_score``: (pid, near_pid, score), ties by near_pid.

    Neighbours come from ``vectors`` itself (self excluded) or, when given, from ``others`` (e.g. user vectors
    against item vectors), over which the trees are then grown.
    """
    u = unit_vectors(vectors, id_col, vec_col)
    if others is None:
        rows = routed(u.withColumn("item", F.lit(True)), trees=trees, leaf=leaf, seed=seed)
        return met(rows.drop("item"), None, k=k, min_score=min_score)
    o = unit_vectors(others, id_col, vec_col)
    both = u.withColumn("item", F.lit(False)).unionByName(o.withColumn("item", F.lit(True)))
    rows = routed(both, trees=trees, leaf=leaf, seed=seed)
    return met(rows.where("not item").drop("item"), rows.where("item").drop("item"), k=k, min_score=min_score)
