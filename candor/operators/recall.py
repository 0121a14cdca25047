"""Personalised candidate generation and the quota merge of recall sources.

Every per-user list is cut with a window limit *before* it is joined or collected
(``WindowGroupLimit`` runs map-side), so a very active user contributes at most
``last_n`` actions and each join fans out by a bounded neighbour/topic list. The neighbour lists of a user's
actions are so many that they meet inside a task (``operators.lists``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import set_down
from .forest import knn_forest
from .knn import knn_exact, knn_lsh
from .lists import best_of_lists
from .skew import top_per_group


def _top(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str = "__rn") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def recent_actions(actions: DataFrame, *, last_n: int = 100) -> DataFrame:
    """Each user's latest ``last_n`` actions (by ts, then event id).

    A user's history is unbounded (bots): it is cut in two levels (``operators.skew``).
    """
    return top_per_group(actions, ["mid"], [F.col("ts").desc(), F.col("event_id").desc()], last_n, name="recency")


def recent_i2i_recall(actions: DataFrame, neighbours: DataFrame, *, last_n: int = 100, k: int = 50) -> DataFrame:
    """Items similar to the user's latest ``last_n`` actions: (mid, pid, score).

    score = best similarity to any recent action; items already in the recent actions are
    excluded; top ``k`` per user by score, ties by pid.
    """
    # score is a max, so repeated actions on one item add nothing; a source that is null has no list and excludes nothing
    r = recent_actions(actions, last_n=last_n).groupBy("mid").agg(F.collect_set("pid").alias("srcs"))
    r = set_down(r.where(F.size("srcs") > 0))
    n = neighbours.select(F.col("pid").alias("src"), F.col("near_pid").alias("pid"), "score")
    return best_of_lists(r, n, k=k, most=last_n)


def topic_interest_recall(
    actions: DataFrame,
    posts: DataFrame,
    scores: DataFrame,
    *,
    as_of: int,
    days: int = 14,
    n_topics: int = 3,
    per_topic: int = 20,
    k: int = 50,
) -> DataFrame:
    """Top posts of the topics a user engaged with in the last ``days``: (mid, pid, score).

    A user's topics are ranked by action count (ties by tid) and the top ``n_topics`` kept;
    each topic offers its ``per_topic`` best-scored posts; posts the user acted on in the
    window are excluded; top ``k`` per user by score, ties by pid.
    """
    p = posts.select("pid", "tid")
    a = actions.filter(F.col("ts") >= F.timestamp_seconds(F.lit(as_of - days * 86400)).cast(actions.schema["ts"].dataType))
    a = a.select("mid", "pid").join(p, "pid", "inner")
    topics = a.groupBy("mid", "tid").agg(F.count(F.lit(1)).alias("n"))
    topics = _top(topics, ["mid"], [F.col("n").desc(), F.col("tid").asc()], n_topics).select("mid", "tid")
    best = top_per_group(scores.join(p, "pid", "inner"), ["tid"], [F.col("score").desc(), F.col("pid").asc()],
                         per_topic, name="__rn")     # a topic's posts are unbounded
    c = topics.join(best.select("tid", "pid", "score"), "tid", "inner")
    c = c.join(a.select("mid", "pid").distinct(), ["mid", "pid"], "left_anti")
    return _top(c.select("mid", "pid", "score"), ["mid"], [F.col("score").desc(), F.col("pid").asc()], k).drop("__rn")


def user_vectors(actions: DataFrame, vectors: DataFrame, *, last_n: int = 20) -> DataFrame:
    """Mean item vector of each user's latest ``last_n`` actions: (mid, vector array<double>)."""
    r = recent_actions(actions, last_n=last_n).select("mid", "pid")
    v = vectors.select("pid", F.col("vector").cast("array<double>").alias("vec"))
    e = r.join(v, "pid", "inner").select("mid", F.posexplode("vec").alias("i", "x"))
    d = e.groupBy("mid", "i").agg(F.avg("x").alias("x"))
    g = d.groupBy("mid").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("__v"))
    return g.select("mid", F.transform("__v", lambda s: s["x"]).alias("vector"))


def user_vector_recall(actions: DataFrame, vectors: DataFrame, *, last_n: int = 20, k: int = 50,
                       method: str = "forest", min_score: float = 0.0, **search) -> DataFrame:
    """Nearest items to each user's mean recent vector: (mid, pid, score).

    ``forest`` (``knn_forest``) and ``lsh`` (``knn_lsh``) are approximate, with cosine >= ``min_score``; ``exact``: all
    pairs, in blocks, as a yardstick on small sets. Further arguments go to the search.
    """
    u = user_vectors(actions, vectors, last_n=last_n).select(F.col("mid").alias("pid"), "vector")
    items = vectors.select("pid", "vector")
    if method in ("forest", "lsh"):
        pairs = (knn_forest if method == "forest" else knn_lsh)(u, k=k, min_score=min_score, others=items, **search)
    else:
        pairs = knn_exact(u, k=k, others=items)
    return pairs.select(F.col("pid").alias("mid"), F.col("near_pid").alias("pid"), "score")


def quota_merge(
    recalls: DataFrame,
    quotas: Mapping[str, tuple[int, int]],
    forced: DataFrame | None = None,
    *,
    k: int = 60,
) -> DataFrame:
    """Merge recall sources per user with per-source lower/upper quotas; forced items first.

    ``recalls``: (mid, pid, source, score). ``quotas``: source -> (min_n, max_n), sources
    listed in priority order. A post offered by several sources keeps its best-priority
    source. Each source keeps at most ``max_n`` posts; its first ``min_n`` are guaranteed
    ahead of the free-for-all tier. Final order: forced, guaranteed, rest -- each by score,
    ties by source priority and pid -- cut to ``k``. Output (mid, pid, source, score, rank).
    """
    prio = F.create_map(*[x for i, s in enumerate(quotas) for x in (F.lit(s), F.lit(i))])
    mn = F.create_map(*[x for s, (lo, _) in quotas.items() for x in (F.lit(s), F.lit(lo))])
    mx = F.create_map(*[x for s, (_, hi) in quotas.items() for x in (F.lit(s), F.lit(hi))])
    r = recalls.filter(F.col("source").isin(*quotas.keys())).select(
        "mid", "pid", "source", F.col("score").cast("double").alias("score"), prio[F.col("source")].alias("prio"),
        F.lit(2).alias("tier"),
    )
    if forced is not None:
        f = forced.select("mid", "pid", F.lit("forced").alias("source"), F.lit(None).cast("double").alias("score"),
                          F.lit(-1).alias("prio"), F.lit(0).alias("tier"))
        r = r.unionByName(f)
    r = r.repartition("mid")  # travels once: all that follows is by user
    r = _top(r, ["mid", "pid"], [F.col("prio").asc(), F.col("score").desc_nulls_last()], 1).drop("__rn")
    w = Window.partitionBy("mid", "source").orderBy(F.col("score").desc_nulls_last(), F.col("pid").asc())
    r = r.withColumn("__rs", F.row_number().over(w))
    r = r.filter((F.col("tier") == 0) | (F.col("__rs") <= mx[F.col("source")]))
    tier = F.when(F.col("tier") == 0, 0).when(F.col("__rs") <= mn[F.col("source")], 1).otherwise(2)
    r = r.withColumn("tier", tier)
    order = [F.col("tier").asc(), F.col("score").desc_nulls_last(), F.col("prio").asc(), F.col("pid").asc()]
    out = _top(r, ["mid"], order, k, "rank")
    return out.select("mid", "pid", "source", "score", F.col("rank").cast("bigint").alias("rank"))
