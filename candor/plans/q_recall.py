"""Registered recall-evaluation and recall-generation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evaluate import (recall_freshness, recall_partition_share, recall_segment_quality, recall_source_quality,
                                  recall_volume)
from ..operators.recall import quota_merge, recent_i2i_recall, topic_interest_recall, user_vector_recall
from ..session import set_down
from ..sources import fixtures as X
from .fixture_sql import with_views
from .params import EVENTS_AS_OF
from .q_i2i import _I2I_CTES, _I2I_VIEWS, near_cte, neighbours
from .registry import register

LAST_N, K_I2I = 100, 50
TOPIC_DAYS, N_TOPICS, PER_TOPIC, K_TOPIC = 14, 3, 20, 50
U2I_LAST_N, K_U2I = 20, 50
QUOTAS = {"i2i": (5, 30), "topic": (5, 20), "u2i": (5, 20)}
K_MERGE = 60

# ---------------------------------------------------------------- evaluation
_SRC_SQL = with_views("""
SELECT source, CAST(sum(exposed) AS BIGINT) AS exposed, CAST(sum(clicked) AS BIGINT) AS clicked,
       sum(exposed) / (SELECT sum(exposed) FROM recall_log) AS exposure_share,
       sum(clicked) / sum(exposed) AS ctr
FROM recall_log GROUP BY source""", "recall_log")


@register("recall_source_quality", _SRC_SQL, ["exposure_share", "ctr"])
def q_recall_source_quality(spark: SparkSession, d: str) -> DataFrame:
    return recall_source_quality(X.recall_log(spark, d))


_SEG_SQL = with_views("""
SELECT source, gender, age, CAST(exposed AS BIGINT) AS exposed, CAST(clicked AS BIGINT) AS clicked,
       exposed / sum(exposed) OVER (PARTITION BY gender, age) AS exposure_share, clicked / exposed AS ctr
FROM (SELECT l.source, coalesce(u.gender, 0) AS gender, coalesce(u.age, 0) AS age,
             sum(l.exposed) AS exposed, sum(l.clicked) AS clicked
      FROM recall_log l LEFT JOIN users u ON u.mid = l.mid GROUP BY 1, 2, 3) g""", "recall_log", "users")


@register("recall_segment_quality", _SEG_SQL, ["exposure_share", "ctr"])
def q_recall_segment_quality(spark: SparkSession, d: str) -> DataFrame:
    return recall_segment_quality(X.recall_log(spark, d), X.users(spark, d))


_PART_SQL = with_views("""
SELECT part1_id, part2_id, CAST(sum(exposed) AS BIGINT) AS exposed,
       sum(exposed) / (SELECT sum(exposed) FROM recall_log) AS post_share
FROM (SELECT l.exposed, CAST(coalesce(t.part1_id, 0) AS BIGINT) AS part1_id, CAST(coalesce(t.part2_id, 72) AS BIGINT) AS part2_id
      FROM recall_log l LEFT JOIN posts p ON p.pid = l.pid LEFT JOIN tax t ON t.tid = p.tid) j
GROUP BY ROLLUP (part1_id, part2_id)""", "recall_log", "posts", "tax")


@register("recall_partition_share", _PART_SQL, ["post_share"])
def q_recall_partition_share(spark: SparkSession, d: str) -> DataFrame:
    return recall_partition_share(X.recall_log(spark, d), X.posts(spark, d), X.taxonomy(spark, d))


_VOLUME_SQL = with_views("""
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, source, CAST(sum(exposed) AS BIGINT) AS served,
       count(DISTINCT mid) AS users, count(DISTINCT pid) AS posts, sum(exposed) / count(DISTINCT mid) AS per_user
FROM recall_log GROUP BY 1, 2""", "recall_log")


@register("recall_volume", _VOLUME_SQL, ["per_user"])
def q_recall_volume(spark: SparkSession, d: str) -> DataFrame:
    return recall_volume(X.recall_log(spark, d))


# the fixture's posts are of 2001, the log of 2024: bands reach accordingly
_FRESH_SQL = with_views("""
SELECT source, max_days, CAST(sum(exposed) AS BIGINT) AS exposed, sum(exposed) / sum(sum(exposed)) OVER (PARTITION BY source) AS share
FROM (SELECT l.source, l.exposed, CAST(CASE WHEN p.pid IS NULL THEN NULL
               WHEN (1706659200 - p.ct) / 86400 < 8130 THEN 8130 WHEN (1706659200 - p.ct) / 86400 < 8150 THEN 8150
               WHEN (1706659200 - p.ct) / 86400 < 8200 THEN 8200 ELSE -1 END AS BIGINT) AS max_days
      FROM recall_log l LEFT JOIN posts p ON p.pid = l.pid) z
GROUP BY source, max_days""", "recall_log", "posts")


@register("recall_freshness", _FRESH_SQL, ["share"])
def q_recall_freshness(spark: SparkSession, d: str) -> DataFrame:
    return recall_freshness(X.recall_log(spark, d), X.posts(spark, d), as_of=EVENTS_AS_OF, bounds=(8130, 8150, 8200))


# ---------------------------------------------------------------- recall generation
_RECENT_CTE = f"""recent AS (
SELECT mid, pid AS src FROM (
  SELECT mid, pid, row_number() OVER (PARTITION BY mid ORDER BY ts DESC, event_id DESC) AS rn FROM actions) z
WHERE rn <= {LAST_N})"""
_I2I_RECALL_CTE = f"""r_i2i AS (
SELECT mid, pid, score FROM (
  SELECT mid, pid, score, row_number() OVER (PARTITION BY mid ORDER BY score DESC, pid) AS rn FROM (
    SELECT r.mid, n.near_pid AS pid, max(n.score) AS score
    FROM recent r JOIN neigh n ON n.pid = r.src
    WHERE NOT EXISTS (SELECT 1 FROM recent s WHERE s.mid = r.mid AND s.src = n.near_pid)
    GROUP BY r.mid, n.near_pid) c) z
WHERE rn <= {K_I2I})"""
_I2I_RECALL_VIEWS = _I2I_VIEWS + ("actions",)
_I2I_RECALL_CTES = _I2I_CTES + [_RECENT_CTE, _I2I_RECALL_CTE]


@register("recent_i2i_recall", with_views("SELECT * FROM r_i2i", *_I2I_RECALL_VIEWS, extra=_I2I_RECALL_CTES), ["score"])
def q_recent_i2i_recall(spark: SparkSession, d: str) -> DataFrame:
    return recent_i2i_recall(X.event_actions(spark, d), neighbours(spark, d), last_n=LAST_N, k=K_I2I)


_TOPIC_CTES = [f"""ta AS (
SELECT a.mid, a.pid, p.tid FROM actions a JOIN posts p ON p.pid = a.pid
WHERE a.ts >= make_timestamp(CAST({(EVENTS_AS_OF - TOPIC_DAYS * 86400)} AS BIGINT) * 1000000))""", f"""topics AS (
SELECT mid, tid FROM (
  SELECT mid, tid, row_number() OVER (PARTITION BY mid ORDER BY count(*) DESC, tid) AS rn FROM ta GROUP BY mid, tid) z
WHERE rn <= {N_TOPICS})""", f"""best AS (
SELECT tid, pid, score FROM (
  SELECT p.tid, p.pid, s.ctr AS score, row_number() OVER (PARTITION BY p.tid ORDER BY s.ctr DESC, p.pid) AS rn
  FROM pool s JOIN posts p ON p.pid = s.pid) z
WHERE rn <= {PER_TOPIC})""", f"""r_topic AS (
SELECT mid, pid, score FROM (
  SELECT t.mid, b.pid, b.score, row_number() OVER (PARTITION BY t.mid ORDER BY b.score DESC, b.pid) AS rn
  FROM topics t JOIN best b ON b.tid = t.tid
  WHERE NOT EXISTS (SELECT 1 FROM ta x WHERE x.mid = t.mid AND x.pid = b.pid)) z
WHERE rn <= {K_TOPIC})"""]


def topic_recall(spark: SparkSession, d: str, pool: DataFrame | None = None) -> DataFrame:
    pool = X.pool(spark, d) if pool is None else pool
    return topic_interest_recall(
        X.event_actions(spark, d), pool.select("pid", "tid"), pool.select("pid", F.col("ctr").alias("score")),
        as_of=EVENTS_AS_OF, days=TOPIC_DAYS, n_topics=N_TOPICS, per_topic=PER_TOPIC, k=K_TOPIC,
    )


@register("topic_interest_recall", with_views("SELECT * FROM r_topic", "actions", "posts", "pool", extra=_TOPIC_CTES),
          ["score"])
def q_topic_interest_recall(spark: SparkSession, d: str) -> DataFrame:
    return topic_recall(spark, d)


_U2I_CTES = [f"""urecent AS (
SELECT mid, pid FROM (
  SELECT mid, pid, row_number() OVER (PARTITION BY mid ORDER BY ts DESC, event_id DESC) AS rn FROM actions) z
WHERE rn <= {U2I_LAST_N})""", """udims AS (
SELECT r.mid, u.i, avg(u.x) AS x
FROM urecent r JOIN (SELECT pid, unnest(range(len(vector))) AS i, unnest(CAST(vector AS DOUBLE[])) AS x FROM vectors) u
  ON u.pid = r.pid
GROUP BY r.mid, u.i)""", """uvec AS (SELECT mid, list(x ORDER BY i) AS vec FROM udims GROUP BY mid)""", """uvecs AS (SELECT mid AS pid, vec AS vector FROM uvec)""",
    near_cte("u2i", "uvecs", "vectors", False, K_U2I, 0.0),
    """r_u2i AS (SELECT pid AS mid, near_pid AS pid, score FROM u2i)"""]


@register("user_vector_recall", with_views("SELECT * FROM r_u2i", "actions", "vectors", extra=_U2I_CTES), ["score"])
def q_user_vector_recall(spark: SparkSession, d: str) -> DataFrame:
    return user_vector_recall(X.event_actions(spark, d), X.item_vectors(spark, d), last_n=U2I_LAST_N, k=K_U2I)


def _quota_sql() -> str:
    prio = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(QUOTAS))
    lo = " ".join(f"WHEN '{s}' THEN {v[0]}" for s, v in QUOTAS.items())
    hi = " ".join(f"WHEN '{s}' THEN {v[1]}" for s, v in QUOTAS.items())
    ctes = _I2I_RECALL_CTES + _TOPIC_CTES + _U2I_CTES + [f"""allr AS (
SELECT mid, pid, 'i2i' AS source, score, CASE 'i2i' {prio} END AS prio, 2 AS tier FROM r_i2i
UNION ALL SELECT mid, pid, 'topic', score, CASE 'topic' {prio} END, 2 FROM r_topic
UNION ALL SELECT mid, pid, 'u2i', score, CASE 'u2i' {prio} END, 2 FROM r_u2i
UNION ALL SELECT t.mid, t.pid, 'forced', CAST(NULL AS DOUBLE), -1, 0 FROM r_topic t JOIN serving s ON s.pid = t.pid
          WHERE s.remaining > 0)""", """dedup AS (
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid, pid ORDER BY prio, score DESC NULLS LAST) AS rn FROM allr) z
WHERE rn = 1)""", f"""capped AS (
SELECT *, row_number() OVER (PARTITION BY mid, source ORDER BY score DESC NULLS LAST, pid) AS rs FROM dedup)""", f"""tiered AS (
SELECT mid, pid, source, score, prio,
       CASE WHEN tier = 0 THEN 0 WHEN rs <= (CASE source {lo} END) THEN 1 ELSE 2 END AS tier
FROM capped WHERE tier = 0 OR rs <= (CASE source {hi} END))"""]
    body = f"""
SELECT mid, pid, source, score, CAST(rank AS BIGINT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY mid ORDER BY tier, score DESC NULLS LAST, prio, pid) AS rank FROM tiered) z
WHERE rank <= {K_MERGE}"""
    return with_views(body, *_I2I_RECALL_VIEWS, "posts", "serving", extra=ctes)


@register("quota_merge", _quota_sql(), ["score"])
def q_quota_merge(spark: SparkSession, d: str) -> DataFrame:
    acts = X.event_actions(spark, d)
    # topics and neighbours read the same posts: lines and orders are joined and summed once
    pool = set_down(X.pool(spark, d).select("pid", "tid", "ptype", "status", "ct", "rec", "ctr"))
    topic = set_down(topic_recall(spark, d, pool))
    r = (
        recent_i2i_recall(acts, neighbours(spark, d, pool), last_n=LAST_N, k=K_I2I).withColumn("source", F.lit("i2i"))
        .unionByName(topic.withColumn("source", F.lit("topic")))
        .unionByName(user_vector_recall(acts, X.item_vectors(spark, d), last_n=U2I_LAST_N, k=K_U2I)
                     .withColumn("source", F.lit("u2i")))
    )
    live = X.serving_budget(spark, d).filter(F.col("remaining") > 0).select("pid")
    forced = topic.join(live, "pid", "inner").select("mid", "pid")
    return quota_merge(r, QUOTAS, forced, k=K_MERGE)
