"""Neighbour lists brought up to date: only what changed is searched.

A list stays right while its own vector and those in it are the same, and vectors that changed don't enter it. So an
incremental run searches

* all items for the vectors that are new or changed, and
* all items for those whose full list lost an entry (one that changed or went): the next one isn't known;

what is new or changed is offered to every other list. Lists shorter than ``k`` hold all there is above
``min_score``, so they lose entries without a search. Items that are gone leave with their lists.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import set_down
from .forest import knn_forest
from .knn import knn_exact
from .skew import top_per_group


def changed_vectors(now: DataFrame, before: DataFrame) -> DataFrame:
    """(pid) of vectors in ``now`` that are new or differ from ``before``."""
    b = before.select(F.col("pid").alias("b_pid"), F.col("vector").alias("b_vector"))
    j = now.join(b, F.col("pid") == F.col("b_pid"), "left")
    return j.where(F.col("b_pid").isNull() | (F.col("vector") != F.col("b_vector"))).select("pid")


def _without_self(near: DataFrame, k: int) -> DataFrame:
    near = near.where(F.col("pid") != F.col("near_pid"))
    return top_per_group(near, ["pid"], [F.col("score").desc(), F.col("near_pid").asc()], k, name="__rn").drop("__rn")


def forest_search(k: int, min_score: float, **forest) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Search through trees over the others; a query may be among them and is left out."""
    return lambda queries, others: _without_self(knn_forest(queries, k=k + 1, min_score=min_score, others=others, **forest), k)


def exact_search(k: int, min_score: float) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Blocked search of all others; a query may be among them and is left out."""
    return lambda queries, others: knn_exact(queries, k=k, others=others, without_self=True).where(F.col("score") >= min_score)


def updated_neighbours(
    now: DataFrame, before: DataFrame, lists: DataFrame, *, k: int, min_score: float,
    search: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Today's top-``k`` lists (pid, near_pid, score) from yesterday's.

    ``now`` and ``before``: (pid, vector); ``lists``: yesterday's (pid, near_pid, score) over ``before`` with the same ``k`` and
    ``min_score``. ``search(queries, others)`` gives the top ``k`` of ``others`` (a query itself left out); by
    default the exact one, with which the result is that of a full run.
    """
    search = search or exact_search(k, min_score)
    now = set_down(now.select("pid", "vector"))
    moved = set_down(changed_vectors(now, before))
    gone = before.select("pid").join(now.select("pid"), "pid", "left_anti")
    touched = set_down(moved.unionByName(gone).distinct())
    full = lists.groupBy("pid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select("pid")
    lost = lists.join(touched.withColumnRenamed("pid", "near_pid"), "near_pid", "left_semi").select("pid").distinct().join(full, "pid", "left_semi")
    again = set_down(moved.unionByName(lost).distinct().join(now.select("pid"), "pid", "left_semi"))
    searched = search(now.join(again, "pid", "left_semi"), now).select("pid", "near_pid", "score")
    rest = now.join(again, "pid", "left_anti")
    kept = lists.join(rest.select("pid"), "pid", "left_semi").join(touched.withColumnRenamed("pid", "near_pid"), "near_pid", "left_anti").select("pid", "near_pid", "score")
    offered = search(rest, now.join(moved, "pid", "left_semi")).select("pid", "near_pid", "score")
    w = Window.partitionBy("pid").orderBy(F.col("score").desc(), F.col("near_pid").asc())  # two lists a pid: 2 * k rows
    best = kept.unionByName(offered).withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop("__rn")
    return searched.unionByName(best)
