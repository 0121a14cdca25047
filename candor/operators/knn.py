"""Top-k cosine neighbours: exact (blocked) and by sign projections (LSH).

``knn_exact`` deals its items to strips of a task each, through which all vectors stream in tiles of ``BLOCK_ROWS``
(``operators.strips``). A pair of tiles is scored with one numpy matrix product, a task holds the best ``k`` of its
items so far, and only these leave it: no all-pairs frame is ever materialised, and nothing is merged after.
The compute is still O(n^2): this is the exact answer for vocabularies that fit that
budget and the recall yardstick for the approximate searches: ``knn_lsh`` below, and the trees of
``operators.forest``, which are the default of every job (the upstream job also uses a tree index).
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import set_down
from .embed import signs_of
from .meet import met
from .strips import NO_ID, strip_count, strip_search

BLOCK_ROWS = 2048  # vectors of a tile: a pair of tiles makes a matrix of some 32 MB


def unit_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(pid, vec): ids as bigint, vectors of unit length as doubles; rows without a vector go."""
    # the norm is a step of its own: inside the lambda it would be worked out for every component
    v = vectors.where(F.col(vec_col).isNotNull())
    v = v.select(F.col(id_col).cast("bigint").alias("pid"), F.col(vec_col).cast("array<double>").alias("v"))
    v = v.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)))
    unit = F.when(F.col("norm") > 0, F.transform("v", lambda x: x / F.col("norm"))).otherwise(F.col("v"))
    return v.select("pid", unit.alias("vec"))


def _block_topk(k: int, exclude_self: bool = True):
    """Pairs of two tiles that may be among the best ``k`` of a left row: none below its ``least`` so far."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"at": [], "near_pid": [], "score": []})
        s = np.vstack(left["vec"].to_numpy()) @ np.vstack(right["vec"].to_numpy()).T
        lid, rid = left["pid"].to_numpy(), right["pid"].to_numpy()
        if exclude_self:
            own = np.flatnonzero(np.isin(lid, rid) & (lid != NO_ID))
            r, c = np.nonzero(lid[own][:, None] == rid[None, :])
            s[own[r], c] = -np.inf      # never a self neighbour
        least = left["least"].to_numpy()
        if k < s.shape[1] and np.isneginf(least).any():
            least = np.maximum(least, np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k])
        r, c = np.nonzero(s >= least[:, None])
        sc = s[r, c]
        keep = np.isfinite(sc)
        return pd.DataFrame({"at": r[keep], "near_pid": rid[c[keep]], "score": sc[keep]})

    return run


def knn_exact(
    vectors: DataFrame,
    *,
    k: int = 200,
    id_col: str = "pid",
    vec_col: str = "vector",
    n_blocks: int | None = None,
    others: DataFrame | None = None,
    without_self: bool | None = None,
) -> DataFrame:
    """Exact top-``k`` cosine neighbours: (pid, near_pid, score), ties by near_pid.

    Neighbours come from ``vectors`` itself (self excluded) or, when given, from ``others``
    (e.g. user vectors against item vectors; ``without_self`` leaves out those of the same id). ``n_blocks``: the number of
    strips, by default as many as ``strips.strip_count`` says; the result is the same for any number.
    """
    u = unit_vectors(vectors, id_col, vec_col)
    o = u if others is None else unit_vectors(others, id_col, vec_col)
    own = others is None if without_self is None else without_self
    n = int(n_blocks or strip_count(u.count(), BLOCK_ROWS))
    return strip_search(u, o, _block_topk(k, exclude_self=own), k=k, strips=n, tile=BLOCK_ROWS)


MICRO = 1_000_000  # unit vectors' components are whole millionths for hashing: their sums are exact


def bands(vec: Column, dim: int, tables: int, bits: int) -> Column:
    """One key per table: the signs of ``bits`` projections of a unit vector on fixed sign vectors."""
    whole = F.transform(vec, lambda x: F.round(x * MICRO).cast("bigint"))
    # a constant, and one expression over it: written out, the planes would be planned one by one
    planes = F.from_json(F.lit(json.dumps([[signs_of(f"plane {t} {b}", dim) for b in range(bits)] for t in range(tables)])), "array<array<array<bigint>>>")

    def keys(v: Column) -> Column:
        dot = lambda plane: F.aggregate(F.zip_with(v, plane, lambda x, s: x * s), F.lit(0).cast("bigint"), lambda a, x: a + x)
        return F.transform(planes, lambda table: F.array_join(
            F.transform(table, lambda plane: F.when(dot(plane) >= 0, F.lit("1")).otherwise(F.lit("0"))), ""))

    return F.get(F.transform(F.array(whole), keys), F.lit(0))  # the whole numbers are bound once, not worked out for every plane


def knn_lsh(
    vectors: DataFrame,
    *,
    k: int = 200,
    min_score: float = 0.5,
    id_col: str = "pid",
    vec_col: str = "vector",
    tables: int = 8,
    bits: int = 6,
    others: DataFrame | None = None,
) -> DataFrame:
    """Approximate top-``k`` neighbours with cosine >= ``min_score``: (pid, near_pid, score).

    Neighbours come from ``vectors`` itself (self excluded) or from ``others``. Two vectors at angle a
    share one projection's sign with probability 1 - a / pi, and are candidates if they agree on
    all ``bits`` signs of some of ``tables`` tables: unrelated vectors in about
    ``tables / 2 ** bits`` of all pairs, near ones mostly. More bits prune more, more tables find
    more. Groups of equal signs are scored as blocks (``operators.meet``). Recall against ``knn_exact``: ``knn_recall``.
    """
    u = unit_vectors(vectors, id_col, vec_col)
    o = u if others is None else unit_vectors(others, id_col, vec_col)
    first = o.select(F.size("vec").alias("dim")).first()
    if first is None:
        return u.select("pid", F.col("pid").alias("near_pid"), F.lit(0.0).alias("score")).limit(0)
    groups = F.transform(bands(F.col("vec"), first["dim"], tables, bits), lambda key: F.conv(key, 2, 10).cast("bigint"))
    left = set_down(u.select("pid", "vec", groups.alias("groups")))
    right = None if others is None else set_down(o.select("pid", "vec", groups.alias("groups")))
    return met(left, right, k=k, min_score=min_score)


def knn_recall(approx: DataFrame, exact: DataFrame, *, min_score: float = 0.5) -> DataFrame:
    """Recall of the approximate pairs against exact pairs with score >= ``min_score``."""
    e = exact.filter(F.col("score") >= min_score).select("pid", "near_pid")
    a = approx.select("pid", "near_pid", F.lit(1).alias("hit"))
    j = e.join(a, ["pid", "near_pid"], "left")
    return j.agg(
        F.count(F.lit(1)).alias("exact_pairs"),
        F.sum(F.coalesce(F.col("hit"), F.lit(0))).alias("found"),
    ).withColumn("recall", F.when(F.col("exact_pairs") > 0, F.col("found") / F.col("exact_pairs")))
