"""All pairs of two sides, scored in strips: what a search that prunes nothing moves and holds.

The left side is dealt to strips, one task each; the right side goes to every strip once and streams through its
task, tile by tile, while the task holds its own vectors and the best of each so far. So the shuffle is one copy of the right
side a strip (``STRIPS`` of them until a strip would hold more than ``STRIP_ROWS`` vectors), nothing is merged after it,
and a task's memory is bounded whatever the tables' size. The number of products stays that of all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRIPS, STRIP_ROWS = 24, 32_768
PAIRS = "pid long, near_pid long, score double"
NO_ID = np.iinfo(np.int64).min  # a null id among int64: sorts first, equals no other

Tile = Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]  # (pid, vec[, groups], least), (pid, vec[, groups]) -> (at, near_pid, score)


def strip_count(rows: int, tile: int) -> int:
    """Strips for ``rows`` left vectors: one for a table of one tile."""
    return 1 if rows <= tile else max(STRIPS, -(-rows // STRIP_ROWS))


def _matrix(column: pa.ListArray) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _frame(rows: pa.RecordBatch) -> pd.DataFrame:
    """(pid, vec[, groups]) of the rows with a finite vector: one that isn't has no score."""
    x = _matrix(rows.column("vec"))
    out = pd.DataFrame({"pid": rows.column("pid").fill_null(int(NO_ID)).to_numpy(zero_copy_only=False), "vec": list(x)})
    if "groups" in rows.schema.names:
        out["groups"] = list(_matrix(rows.column("groups")))
    return out[np.isfinite(x).all(axis=1)].reset_index(drop=True)


def _first(by: np.ndarray, near: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` of each ``by``, by descending score, ties by smaller near."""
    order = np.lexsort((near, -score, by))
    start = np.flatnonzero(np.r_[True, by[order][1:] != by[order][:-1]]) if len(order) else np.zeros(0, np.int64)
    nth = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    return order[nth < k]


class _Held:
    """One tile's worth of left vectors and the best pairs of each so far."""

    def __init__(self, left: pd.DataFrame, k: int):
        self.left, self.k, self.new = left.assign(least=-np.inf), k, 0
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]

    def meet(self, right: pd.DataFrame, topk: Tile) -> None:
        t = topk(self.left, right)
        self.found.append((t["at"].to_numpy(np.int64), t["near_pid"].to_numpy(np.int64), t["score"].to_numpy(np.float64)))
        self.new += len(t)
        if self.new > self.k * len(self.left):
            self.cut()

    def cut(self) -> None:
        at, near, score = (np.concatenate(x) for x in zip(*self.found))
        best = _first(at, near, score, self.k)
        at, near, score = at[best], near[best], score[best]
        self.found, self.new = [(at, near, score)], 0
        n = np.bincount(at, minlength=len(self.left))
        least, full = np.full(len(self.left), -np.inf), n >= self.k
        least[full] = score[np.cumsum(n)[full] - 1]
        self.left["least"] = least


def _finished(held: list[_Held], k: int) -> Iterator[pa.RecordBatch]:
    """Lists by id: rows of one id, which lie in one strip, share a list."""
    ids = np.concatenate([h.left["pid"].to_numpy(np.int64) for h in held]) if held else np.zeros(0, np.int64)
    twice = pd.unique(ids[pd.Series(ids).duplicated().to_numpy()])
    late = []
    for h in held:
        h.cut()
        at, near, score = h.found[0]
        pid = h.left["pid"].to_numpy(np.int64)[at]
        shared = np.isin(pid, twice)
        late.append((pid[shared], near[shared], score[shared]))
        yield _batch(pid[~shared], near[~shared], score[~shared])
        h.found = []
    if len(twice):
        pid, near, score = (np.concatenate(x) for x in zip(*late))
        best = _first(pid, near, score, k)
        yield _batch(pid[best], near[best], score[best])


def _batch(pid: np.ndarray, near: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pid, mask=pid == NO_ID), pa.array(near, mask=near == NO_ID), pa.array(score)], ["pid", "near_pid", "score"])


def strip_search(items: DataFrame, others: DataFrame, topk: Tile, *, k: int, strips: int, tile: int) -> DataFrame:
    """The ``k`` best of ``others`` for each id of ``items`` among what ``topk`` finds in a pair of tiles: (pid, near_pid, score).

    Both are (pid, vec[, groups]); a tile has ``tile`` vectors at most. Ties go to smaller near_pid.
    """
    columns = [c for c in ("pid", "vec", "groups") if c in items.columns]
    # a strip's own rows come before the others: even turns hold them
    own = items.select(F.pmod(F.xxhash64("pid"), F.lit(strips)).cast("int").alias("strip"), F.lit(0).alias("side"), *columns)
    all_of = others.select(F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("strip"), F.lit(1).alias("side"), *columns)
    both = own.unionByName(all_of).repartitionById(strips, "strip").sortWithinPartitions("strip", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip, left, held = None, [], []
        for batch in batches:
            turn = batch.column("strip").to_numpy() * 2 + batch.column("side").to_numpy()
            cuts = np.flatnonzero(np.r_[True, turn[1:] != turn[:-1]]) if len(turn) else []
            for a, b in zip(cuts, [*cuts[1:], len(turn)]):
                if turn[a] // 2 != strip:
                    yield from _finished(held, k)
                    strip, left, held = turn[a] // 2, [], []
                rows = _frame(batch.slice(a, b - a))
                if turn[a] % 2 == 0:
                    left.append(rows)
                    continue
                if left:
                    mine, left = pd.concat(left, ignore_index=True), []
                    held = [_Held(mine.iloc[i:i + tile].reset_index(drop=True), k) for i in range(0, len(mine), tile)]
                for j in range(0, len(rows), tile):
                    part = rows.iloc[j:j + tile].reset_index(drop=True)
                    for h in held:
                        h.meet(part, topk)
        yield from _finished(held, k)

    return both.mapInArrow(run, PAIRS)
