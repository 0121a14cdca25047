"""Top-k cosine pairs among vectors that share a group in one of several tables.

Both approximate searches end here: hash tables (``knn_lsh``) and trees (``forest``) put every vector into
one group a table, and two vectors are candidates if they share a group in any table. Groups are scored as
blocks, one matrix product a task, so candidate pairs never become rows: a pair counts in the first table where it
meets, and each vector leaves a task with one row that holds its best ``k`` there. A group larger than
``PART`` vectors is cut into parts, and its parts meet pairwise, so no task holds a hot group whole. Where the groups hold
as many pairs as there are in all, every pair is scored once instead (``operators.strips``) and kept if it shares a group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import set_down
from .strips import NO_ID, strip_count, strip_search

PART = 2048
FOUND = "pid long, near_pids array<long>, scores array<double>"


def _best(a: pd.DataFrame, b: pd.DataFrame, table: int, k: int, min_score: float, own: bool) -> pd.DataFrame:
    """For each row of ``a`` its ``k`` best rows of ``b`` that it hasn't met in an earlier table."""
    x, y = np.vstack(a["vec"].to_numpy()), np.vstack(b["vec"].to_numpy())
    score = x @ y.T
    no = score < min_score
    if own:
        no |= a["pid"].to_numpy()[:, None] == b["pid"].to_numpy()[None, :]
    if table:
        g, h = np.vstack(a["groups"].to_numpy())[:, :table], np.vstack(b["groups"].to_numpy())[:, :table]
        for t in range(table):
            no |= g[:, t][:, None] == h[:, t][None, :]
    score[no] = -np.inf
    ids = b["pid"].to_numpy()
    order = np.argsort(ids, kind="stable")  # ties go to smaller ids
    score, ids = score[:, order], ids[order]
    out = []
    for r, pid in enumerate(a["pid"].tolist()):
        at = np.flatnonzero(score[r] > -np.inf)
        if len(at) > k:
            s = score[r, at]
            at = at[s >= np.partition(s, len(s) - k)[len(s) - k]]
        if len(at):
            at = at[np.argsort(-score[r, at], kind="stable")][:k]
            out.append((pid, ids[at], score[r, at]))
    return pd.DataFrame(out, columns=["pid", "near_pids", "scores"]).astype({"near_pids": object, "scores": object})


def _sharing(k: int, min_score: float, own: bool):
    """Pairs of two tiles (``strips``) that share a group in any table and may be among the best ``k`` of a left row."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"at": [], "near_pid": [], "score": []})
        s = np.vstack(left["vec"].to_numpy()) @ np.vstack(right["vec"].to_numpy()).T
        r, c = np.nonzero(s >= np.maximum(left["least"].to_numpy(), min_score)[:, None])
        lid, rid = left["pid"].to_numpy(), right["pid"].to_numpy()
        if own:
            other = (lid[r] != rid[c]) | (lid[r] == NO_ID)
            r, c = r[other], c[other]
        g, h = np.vstack(left["groups"].to_numpy()), np.vstack(right["groups"].to_numpy())
        share, rest = np.zeros(len(r), bool), np.arange(len(r))
        for t in range(g.shape[1]):
            same = g[r[rest], t] == h[c[rest], t]
            share[rest[same]], rest = True, rest[~same]
        return pd.DataFrame({"at": r[share], "near_pid": rid[c[share]], "score": s[r[share], c[share]]})

    return run


def met(items: DataFrame, others: DataFrame | None, *, k: int, min_score: float) -> DataFrame:
    """The ``k`` best of ``others`` (of ``items`` itself, without self, if None) for each item: (pid, near_pid, score).

    Both are (pid, vec, groups): unit vectors and the group of every table, a long each. Ties go to smaller near_pid.
    """
    own = others is None
    o = items if own else others
    key = ["table", "group"]
    ids = lambda d: d.select("pid", F.posexplode("groups").alias("table", "group"))
    held = lambda d, name: ids(d).groupBy(*key).agg(F.count(F.lit(1)).alias(name))
    sizes = held(items, "a_n")
    sizes = sizes.withColumn("b_n", F.col("a_n")) if own else sizes.join(held(o, "b_n"), key)
    parts = lambda n: F.ceil(F.col(n) / PART).cast("int")
    sizes = set_down(sizes.select(*key, "a_n", "b_n", parts("a_n").alias("a_parts"), parts("b_n").alias("b_parts")))
    pairs = sizes.agg(F.sum(F.col("a_n").cast("double") * F.col("b_n"))).first()[0] or 0.0
    n = items.count()
    if pairs >= n * (n if own else o.count()) > 0:
        return strip_search(items, o, _sharing(k, min_score, own), k=k, strips=strip_count(n, PART), tile=PART)
    sizes = sizes.drop("a_n", "b_n")
    dealt = lambda n: F.pmod(F.xxhash64("pid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    laid = lambda d: d.select("pid", "vec", "groups", F.posexplode("groups").alias("table", "group")).join(sizes, key)
    by = [*key, "a", "b"]

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"pid": [], "near_pids": [], "scores": []}, dtype=object)
        return _best(a, b, int(key[0]), k, min_score, own)

    def run_own(key: tuple, v: pd.DataFrame) -> pd.DataFrame:
        if key[2] == key[3]:
            return run(key, v, v)
        a, b = v[v["part"] == key[2]], v[v["part"] == key[3]]
        return pd.concat([run(key, a, b), run(key, b, a)], ignore_index=True)

    if own:  # a pair of parts meets once, for both its sides: one copy of a vector where its group has one part
        d = laid(items).withColumn("part", dealt("a_parts"))
        with_part = F.transform(F.sequence(F.lit(0), F.col("a_parts") - 1), lambda x: F.struct(
            F.least(x, F.col("part")).alias("a"), F.greatest(x, F.col("part")).alias("b")))
        d = d.select(*key, "pid", "vec", "groups", "part", F.explode(with_part).alias("x")).select("*", "x.a", "x.b").drop("x")
        found = d.groupBy(*by).applyInPandas(run_own, FOUND)
    else:
        columns = [F.col(c).alias(c) for c in (*key, "pid", "vec", "groups")]  # columns of its own: both sides may be one table
        left = laid(items).select(*columns, dealt("a_parts").alias("a"), every("b_parts").alias("b"))
        right = laid(o).select(*columns, dealt("b_parts").alias("b"), every("a_parts").alias("a"))
        found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(run, FOUND)
    # a row a table and part: at most k of each
    near = F.flatten(F.collect_list(F.transform(F.arrays_zip("near_pids", "scores"), lambda x: F.struct(
        (-x["scores"]).alias("less"), x["near_pids"].alias("near_pid")))))
    best = found.groupBy("pid").agg(F.slice(F.sort_array(near), 1, k).alias("near"))
    return best.select("pid", F.explode("near").alias("x")).select("pid", "x.near_pid", (-F.col("x.less")).alias("score"))
