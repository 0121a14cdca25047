"""Hard negatives: exact inner-product search through STR-packed R-trees.

Components are whole numbers, so scores are too and nothing is rounded. For each anchor the nearest rows
of its label are its positives; each positive opens a score window, and the nearest rows of other labels
inside the window are the hard negatives.

Index. Distinct vectors of a label are one entry with its smallest ids (as many as can be returned: they tie,
and ties go to smaller ids), so copies, however many, are a few ids. Entries are sorted globally by the widest
coordinate and cut into slabs of ``SLAB``, the top level of the tree. A task packs its slab by
sort-tile-recursive: sorted on the coordinate with the widest spread, cut into tiles, each tile sorted
on the next one, down to leaves of ``LEAF`` entries; parents hold ``FAN`` neighbours each.

Search. A box bounds a query's inner product: coordinate by coordinate the product lies between those with the
box's two ends. A queue pops boxes by upper bound, best first. A box is passed over if its bounds
meet no score window that still takes rows, and a window takes no box that is strictly below its
last place; equal bounds are opened, as ties go by vec_id. One walk serves all windows of an
anchor. Anchors meet slabs in blocks of at most ``PART`` anchors and ``SLAB`` entries a task; each returns
its best few, which a two-level top-k merges.

Defined results: rows with a null label, a null vector, a null or non-finite component take no part, nor do
rows without vec_id, with a vector of another length than most (the smaller length wins a tie), or with a component
of 2 ** 24 or more (whose scores a long might not hold). Repeated rows count once; of rows
that share a vec_id and differ, the one with the least (label, vector) counts. Anchors without positives, positives without negatives give no rows; an empty table gives none. vec_id,
embedding and label are read by name, so further columns can have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.skew import skew_safe_row_number, top_per_group
from .common import materialise, require, table

SLAB, PART = 4096, 2048
LEAF, FAN = 256, 8
SCALE, LIMIT = 256, 2**24


def whole_rows(vectors: DataFrame) -> DataFrame:
    """Rows that take part: vec_id, label (moved on by one for ids divisible by 7) and ``x``, whole numbers."""
    rows = require(vectors, ["vec_id", "embedding", "label"])
    v = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(LIMIT // SCALE)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    label = F.col("label").cast("long")
    rows = rows.select(F.col("vec_id").cast("long"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), v.alias("x"))
    n = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    rows = rows.where(F.size("x") == (n[0]["n"] if n else 0))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row")).select("vec_id", "row.label", "row.x")


class Tree:
    """An STR-packed R-tree over the rows of a matrix. ``order``: rows in leaf order; ``levels``: (low, high) boxes
    of every level, leaves first; a parent's children are ``FAN`` neighbours of the level below."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF, fan: int = FAN):
        self.leaf, self.fan = leaf, fan
        wide = np.argsort(-(x.max(0) - x.min(0)), kind="stable")
        self.order = self._packed(x, np.arange(len(x)), list(wide[:4]))
        x = x[self.order]
        cuts = np.arange(0, len(x), leaf)
        self.levels = [(np.minimum.reduceat(x, cuts), np.maximum.reduceat(x, cuts))]
        while len(self.levels[-1][0]) > 1:
            low, high = self.levels[-1]
            cuts = np.arange(0, len(low), fan)
            self.levels.append((np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)))

    def _packed(self, x: np.ndarray, rows: np.ndarray, dims: list[int]) -> np.ndarray:
        leaves = -(-len(rows) // self.leaf)
        if leaves <= 1 or not dims:
            return rows
        rows = rows[np.argsort(x[rows, dims[0]], kind="stable")]
        tiles = int(np.ceil(leaves ** (1 / len(dims))))
        width = -(-leaves // tiles) * self.leaf  # whole leaves
        return np.concatenate([self._packed(x, rows[i:i + width], dims[1:]) for i in range(0, len(rows), width)])

    def bounds(self, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Least and largest inner product of every query (row of ``q``) with anything in every box, by level."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return [(up @ low.T + down @ high.T, up @ high.T + down @ low.T) for low, high in self.levels]


class _Window:
    """The first ``k`` of the rows whose score lies in [least, most] (None: no such end)."""

    __slots__ = ("k", "least", "most", "best")

    def __init__(self, least: int | None, most: int | None, k: int):
        self.k, self.best = k, []
        self.least, self.most = -np.inf if least is None else least, np.inf if most is None else most

    def takes(self, low: float, high: float) -> bool:
        if high < self.least or low > self.most:
            return False
        return len(self.best) < self.k or min(high, self.most) >= -self.best[-1][0]

    def add(self, rows: list[tuple[float, int]]) -> None:
        """Takes (-score, vec_id) pairs."""
        self.best = sorted(self.best + rows)[:self.k]


def walk(tree: Tree, x: np.ndarray, ids: list[list[int]], fits: np.ndarray, q: np.ndarray, bounds: list, windows: list[_Window], own: int) -> None:
    """Fill ``windows`` with the rows of ``x`` (in leaf order; ``ids`` and ``fits`` too) for query ``q``.

    ``fits`` marks the rows with a label that counts; rows with id ``own`` don't.
    """
    top = len(tree.levels) - 1
    heap = [(-bounds[top][1][0], top, 0)]
    while heap:
        high, level, box = heapq.heappop(heap)
        if not any(w.takes(bounds[level][0][box], -high) for w in windows):
            continue
        if level:
            low, most = bounds[level - 1]
            for child in range(box * tree.fan, min((box + 1) * tree.fan, len(low))):
                if any(w.takes(low[child], most[child]) for w in windows):
                    heapq.heappush(heap, (-most[child], level - 1, child))
            continue
        begin = box * tree.leaf
        score = x[begin:begin + tree.leaf] @ q
        here = fits[begin:begin + tree.leaf]
        for w in windows:
            least = w.least if len(w.best) < w.k else max(w.least, -w.best[-1][0])
            at = np.flatnonzero(here & (score >= least) & (score <= w.most))
            if (less := len(at) - w.k - 1) > 0:  # one more, as ``own`` may be among them; ties of the last place stay
                at = at[score[at] >= np.partition(score[at], less)[less]]
            if len(at):
                w.add([(-score[r], i) for r in at.tolist() for i in ids[begin + r] if i != own])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)  # exact: components are below 2 ** 24


def _exact(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As doubles if every inner product (and bound) is exact in one, else as Python integers."""
    most = (np.abs(x).max(initial=0) + 1) * (np.abs(y).max(initial=0) + 1) * max(1, x.shape[1])
    return (x, y) if most < 2**53 else (x.astype(np.int64).astype(object), y.astype(np.int64).astype(object))


def searched(entries: DataFrame, n_slabs: int, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """For every anchor (anchor_id, label, x, windows: positive_id, least, most) and window the first ``k`` entries of its
    label (``same``) or of any other, by slab: anchor_id, positive_id, vec_id, score."""
    n_parts = max(1, -(-anchors.count() // PART))
    part = F.pmod(F.xxhash64("anchor_id"), F.lit(n_parts)).cast("int")
    left = anchors.select("*", part.alias("part"), F.explode(F.sequence(F.lit(0), F.lit(n_slabs - 1))).alias("slab"))
    right = entries.select("label", "x", "ids", "slab", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))).alias("part"))

    def best(a: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(e):
            x, q = _matrix(e["x"]), _matrix(a["x"])
            tree = Tree(x)
            x, labels = x[tree.order], e["label"].to_numpy()[tree.order]
            ids = [e["ids"].iloc[r].tolist() for r in tree.order.tolist()]
            x, q = _exact(x, q)
            if x.dtype == object:
                tree.levels = [(low.astype(np.int64).astype(object), high.astype(np.int64).astype(object)) for low, high in tree.levels]
            bounds = tree.bounds(q)
            for n, (anchor, label, own) in enumerate(zip(a["anchor_id"].tolist(), a["label"].tolist(), a["windows"], strict=True)):
                windows = [_Window(w["least"], w["most"], k) for w in own]
                walk(tree, x, ids, labels == label if same else labels != label, q[n], [(lo[n], hi[n]) for lo, hi in bounds], windows, anchor)
                out += [(anchor, w["positive_id"], i, int(-s)) for w, got in zip(own, windows, strict=True) for s, i in got.best]
        rows = pd.DataFrame(out, columns=["anchor_id", "positive_id", "vec_id", "score"])
        return rows.astype({"anchor_id": "int64", "positive_id": "Int64", "vec_id": "int64", "score": "int64"})

    return left.groupBy("slab", "part").cogroup(right.groupBy("slab", "part")).applyInPandas(
        best, "anchor_id bigint, positive_id bigint, vec_id bigint, score bigint")


def _window(positive: Column, least: Column, most: Column) -> Column:
    return F.struct(positive.cast("long").alias("positive_id"), least.cast("long").alias("least"), most.cast("long").alias("most"))


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """For each row whose vec_id is divisible by ``every`` and each of its ``positives`` nearest of its label the first
    ``negatives`` rows of other labels with low * positive <= 100 * score <= high * positive."""
    rows = materialise(whole_rows(vectors), "negatives-rows")
    keep = max(positives, negatives) + 1  # its own id may be one
    by_id = Window.partitionBy("label", "x").orderBy("vec_id")
    entries = rows.withColumn("place", F.dense_rank().over(by_id)).where(F.col("place") <= keep)
    entries = entries.groupBy("label", "x").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    size = rows.select(F.size("x")).limit(1).collect()
    dims = size[0][0] if size else 0
    spans = rows.agg(*[(F.max(F.col("x")[d]) - F.min(F.col("x")[d])).alias(str(d)) for d in range(dims)]).first() if dims else ()
    widest = max(range(dims), key=lambda d: (spans[d], -d)) if dims else None
    first = F.col("x")[widest] if dims else F.lit(0).cast("long")
    numbered = skew_safe_row_number(entries.withColumn("first", first), [], [F.col("first").asc(), F.col("ids")[0].asc(), F.col("label").asc(), F.col("x").asc()])
    numbered = materialise(numbered.select("label", "x", "ids", "rn"), "negatives-numbered")
    n = numbered.count()
    n_slabs = max(1, -(-n // SLAB))  # of equal size
    entries = numbered.select("label", "x", "ids", F.expr(f"cast((rn - 1) * {n_slabs} div {max(n, 1)} as int)").alias("slab"))

    anchors = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("anchor_id"), "label", "x")
    anywhere = F.array(_window(F.lit(None), F.lit(None), F.lit(None)))
    found = materialise(searched(entries, n_slabs, anchors.withColumn("windows", anywhere), positives, True), "negatives-positives")
    order = [F.col("score").desc(), F.col("vec_id").asc()]
    nearest = top_per_group(found, ["anchor_id"], order, positives).drop("rn")
    nearest = nearest.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    nearest = materialise(nearest, "negatives-nearest")
    # 100 * score between low and high times the positive's: whole scores, so the ends are rounded inwards
    window = _window(F.col("positive_id"), F.expr(f"(positive_score * {low} + 99) div 100"), F.expr(f"positive_score * {high} div 100"))
    windows = nearest.where("positive_score >= 0").groupBy(F.col("anchor_id").alias("of")).agg(F.collect_list(window).alias("windows"))  # a negative score has no window
    asked = anchors.join(windows, F.col("anchor_id") == F.col("of")).drop("of")
    found = materialise(searched(entries, n_slabs, asked, negatives, False), "negatives-found")
    first_few = top_per_group(found, ["anchor_id", "positive_id"], order, negatives, name="rank")
    at = nearest.select(F.col("anchor_id").alias("a"), F.col("positive_id").alias("p"), "positive_score")
    out = first_few.join(at, (F.col("anchor_id") == F.col("a")) & (F.col("positive_id") == F.col("p")))
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                      "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for every hundredth row."""
    return mine(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT * FROM (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n
                 FROM s WHERE same) z WHERE n <= 5),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
