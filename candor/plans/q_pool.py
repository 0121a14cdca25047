"""Registered queries: review board, taxonomy, community index, pool clean, counters, standard gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.community import community_review_index
from ..operators.counters import COUNTER_FIELDS, counters_from_columns, post_counters, post_standard_gate
from ..operators.pool import pool_clean
from ..operators.review import review_board, taxonomy_flat
from ..sources import fixtures as X
from .fixture_sql import with_views
from .params import AS_OF, COMMUNITY_DAYS, REVIEW_SINCE_DAY
from .registry import register

# ---------------------------------------------------------------- review board
_REVIEW_SQL = with_views(f"""
SELECT pid, CAST(sum(review) AS BIGINT) AS review_cnt, CAST(count(*) AS BIGINT) AS expose,
       sum(review) / count(*) AS comment_rate
FROM (SELECT a.pid, CASE WHEN a.create_review + a.reply_review >= 2 THEN 2 ELSE a.create_review + a.reply_review END AS review
      FROM ups a LEFT JOIN posts b ON a.pid = b.pid
      WHERE strftime(make_timestamp(b.ct * 1000000), '%Y%m%d') >= '{REVIEW_SINCE_DAY}'
        AND a.ymd >= '{REVIEW_SINCE_DAY}' AND a.expose > 0) t
GROUP BY pid
HAVING sum(review) >= 5 AND sum(review) / count(*) >= 0.004""", "ups", "posts")


@register("review_board", _REVIEW_SQL, ["comment_rate"])
def q_review_board(spark: SparkSession, d: str) -> DataFrame:
    return review_board(X.behaviour(spark, d), X.posts(spark, d), since_day=REVIEW_SINCE_DAY)


# ---------------------------------------------------------------- taxonomy
_TAX_SQL = """
WITH n AS (SELECT CAST(n_nationkey AS BIGINT) AS k, CAST(n_regionkey AS BIGINT) AS r FROM nation),
tree AS (
  SELECT r + 13 AS _id, 100 AS status, list({'_id': k + 70, 'ct': k, 'status': CASE WHEN k % 8 = 7 THEN -1 ELSE 100 END}) AS child_list
  FROM n GROUP BY r
  UNION ALL
  SELECT r + 113, CASE WHEN r = 1 THEN -5 ELSE 100 END, list({'_id': k + 70, 'ct': k + (k % 2) * 10 - 5, 'status': CAST(NULL AS INTEGER)})
  FROM n WHERE k % 3 = 0 GROUP BY r
  UNION ALL
  SELECT -r - 1, 100, list({'_id': k + 270, 'ct': k, 'status': 100}) FROM n GROUP BY r),
p1 AS (SELECT _id AS part1_id, unnest(child_list) AS c FROM tree WHERE _id >= 0 AND coalesce(status, 100) >= 0),
p2 AS (SELECT part1_id, c._id AS part2_id, coalesce(c.ct, 0) AS part2_ct FROM p1
       WHERE c._id >= 0 AND coalesce(c.status, 100) >= 0),
parts AS (SELECT part2_id, part1_id, part2_ct FROM (
            SELECT *, row_number() OVER (PARTITION BY part2_id ORDER BY part2_ct DESC, part1_id DESC) AS rn FROM p2) WHERE rn = 1),
pt AS (SELECT k + 70 AS part2_id, k AS tid FROM n UNION ALL SELECT k + 70, (k + 1) % 25 FROM n WHERE k % 4 = 0),
t AS (SELECT pt.tid, pt.part2_id, parts.part1_id, parts.part2_ct FROM pt JOIN parts ON parts.part2_id = pt.part2_id)
SELECT tid, part2_id, part1_id FROM (
  SELECT *, row_number() OVER (PARTITION BY tid ORDER BY part2_ct DESC, part2_id DESC) AS rn FROM t) WHERE rn = 1"""


@register("taxonomy_flat", _TAX_SQL)
def q_taxonomy_flat(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy_flat(X.taxonomy_raw(spark, d), X.part_tids(spark, d))


# ---------------------------------------------------------------- community review index
# Pieces of 5 posts, so that lists are split; production lists have pieces of 50,000.
COMMUNITY_CHUNK = 5
_COMMUNITY_SQL = with_views("""
SELECT index_key || '#' || CAST(chunk AS VARCHAR) AS index_key, chunk, value, n_items, expires_at FROM pieces
UNION ALL
SELECT index_key, CAST(-1 AS BIGINT), CAST(count(*) AS VARCHAR), CAST(0 AS BIGINT), expires_at FROM pieces GROUP BY index_key, expires_at""",
    "pool", "counters", "tax", extra=[
    """d AS (SELECT pid, ptype, tid FROM pool
          WHERE status = 2 AND ct >= 1004918400 - 90 * 86400 AND community_tag IN (1040, 1050))""",
    """j AS (SELECT d.pid, d.ptype, d.tid, coalesce(c.rec, 0) AS rec, coalesce(c.review, 0) AS review
          FROM d LEFT JOIN counters c ON c.pid = d.pid)""",
    r"""f AS (SELECT j.pid, coalesce(t.part2_id, 72) AS part2_id,
                 CASE WHEN j.ptype = 5 THEN 'video' ELSE 'img' END AS kind,
                 CASE WHEN j.rec > 0 THEN regexp_replace(regexp_replace(printf('%.4f', j.review / j.rec), '0+$', ''), '\.$', '.0')
                      ELSE '0' END AS txt
          FROM j LEFT JOIN tax t ON t.tid = j.tid WHERE j.review < 20 AND j.rec < 10000)""",
    """o AS (SELECT *, row_number() OVER (PARTITION BY kind, part2_id ORDER BY CAST(txt AS DOUBLE) DESC, pid) - 1 AS pos FROM f)""",
    """g AS (SELECT kind, part2_id, pos // 5 AS chunk, string_agg(CAST(pid AS VARCHAR) || ':' || txt, ',' ORDER BY pos) AS value,
                 count(*) AS n
          FROM o GROUP BY kind, part2_id, pos // 5)""",
    """pieces AS (
SELECT 'index_part2_community_review_' || k.kind || '_' || CAST(k.part2_id AS VARCHAR) AS index_key,
       CAST(coalesce(g.chunk, 0) AS BIGINT) AS chunk, coalesce(g.value, '') AS value, CAST(coalesce(g.n, 0) AS BIGINT) AS n_items,
       CAST(1004918400 + 3 * 86400 AS BIGINT) AS expires_at
FROM (SELECT part2_id, unnest(['video', 'img']) AS kind FROM (SELECT DISTINCT part2_id FROM tax) t) k
LEFT JOIN g ON g.kind = k.kind AND g.part2_id = k.part2_id)""",
])


@register("community_review_index", _COMMUNITY_SQL)
def q_community_review_index(spark: SparkSession, d: str) -> DataFrame:
    return community_review_index(
        X.pool_docs(spark, d), X.counters(spark, d), X.taxonomy(spark, d), as_of=AS_OF, days=COMMUNITY_DAYS, chunk=COMMUNITY_CHUNK
    )


# ---------------------------------------------------------------- pool clean
# The override epoch (2020 upstream) is moved to 40 days before the fixture's day, so that it takes part.
POOL_OVERRIDE_SINCE = 1001462400
_POOL_SQL = with_views("""
SELECT p.pid, p.mid, p.tid, p.ptype, p.gid, p.ct, p.rec, p.download AS download_num, p."like" AS like_num,
       (p.pid % 37) / 8.0::DOUBLE AS score_mix, CAST(p.ct - p.pid % 1000 AS BIGINT) AS gid_ct,
       CAST(CASE WHEN p.pid % 31 <> 0 THEN p.pid % 67 ELSE 0 END AS BIGINT) AS fans,
       CAST(CASE WHEN p.pid % 31 <> 0 THEN p.pid % 71 ELSE 0 END AS BIGINT) AS atts,
       CAST(p.pid % 12 IN (0, 2) AS BIGINT) AS is_vulgar, CAST(p.pid % 12 IN (1, 2) AS BIGINT) AS is_sexy, p.choice_status,
       CASE WHEN p.pid % 4 = 0 THEN CAST(p.pid % 3 AS VARCHAR) || ',' || CAST(p.pid % 5 AS VARCHAR) ELSE '' END AS choice_types,
       p.vdur, CAST(p.pid % 83 AS BIGINT) AS real_sume, p.ctr, (p.pid % 89) / 128.0::DOUBLE AS play_rate,
       (p.pid % 97) / 64.0::DOUBLE AS dtr, (p.pid % 79) / 4.0::DOUBLE AS qscore, (p.pid % 41) / 16.0::DOUBLE AS age_tgi,
       p.mover_level, p.mover_part_id, p.review_cnt,
       CAST(p.pid % 6 * 7 AS BIGINT) AS community_tag_new, CAST(p.pid % 7 * 11 AS BIGINT) AS community_tag_high,
       CAST(p.pid % 9 * 13 AS BIGINT) AS community_pre_tag, CAST(p.pid % 73 AS BIGINT) AS share_num,
       CASE WHEN p.step_boot = 0 AND p.ct >= 1001462400 AND o.pid IS NOT NULL THEN o.step_boot ELSE p.step_boot END AS step_boot,
       CASE WHEN p.step_boot = 0 AND p.ct >= 1001462400 AND o.pid IS NOT NULL THEN o.step_boot_t ELSE p.step_boot_t END AS step_boot_t,
       CAST(p.pid % 10 * 17 AS BIGINT) AS community_tag_godrev, p.subarea_status,
       CASE WHEN p.n_subarea_types = 1 THEN '3' ELSE '' END AS subarea_types, CAST(p.pid % 43 AS BIGINT) AS like_bait,
       p.resource_status, CAST(p.pid * 3 AS BIGINT) AS subarea_time, CAST(p.pid % 101 AS BIGINT) AS detail_cnt,
       CASE WHEN p.pid % 5 <> 0 THEN 'src' || CAST(p.pid % 5 AS VARCHAR) ELSE '' END AS source,
       CAST(p.pid % 47 AS BIGINT) AS original, CAST(p.pid % 53 AS BIGINT) AS assist_status,
       CAST(p.pid % 59 AS BIGINT) AS official_template_id, CAST(p.pid % 61 AS BIGINT) AS community_hashtag_post
FROM pool p LEFT JOIN step_override o ON o.pid = p.pid
WHERE p.pid > 0 AND p.gid > 0 AND p.ptype > 1 AND p.status >= 2
  AND NOT (1004918400 - p.ct > 30 * 86400 AND p.rec < 1000)
  AND NOT (1004918400 - p.ct > 120 * 86400 AND p.choice_status < 30)
  AND NOT (1004918400 - p.ct > 30 * 86400 AND p.download / (p.rec + CAST(10 AS DOUBLE)) < 0.003
           AND p."like" / (p.rec + CAST(10 AS DOUBLE)) < 0.003)""", "pool", "step_override")


@register("pool_clean", _POOL_SQL, ["score_mix", "ctr", "play_rate", "dtr", "qscore", "age_tgi"])
def q_pool_clean(spark: SparkSession, d: str) -> DataFrame:
    return pool_clean(X.pool_docs(spark, d), X.step_override(spark, d), as_of=AS_OF, override_since_ct=POOL_OVERRIDE_SINCE)


# ---------------------------------------------------------------- post counters
def _counter_cols(prefix_sql: str, prefix_out: str) -> list[str]:
    out = []
    for f in COUNTER_FIELDS:
        src = f'"{prefix_sql}{f}"'
        out.append(f"{src} / 1000 AS \"{prefix_out}{f}\"" if f == "play_dur" else f'{src} AS "{prefix_out}{f}"')
    return out


_COUNTER_OUT = ["pid"] + _counter_cols("", "") + [c for g in (0, 1, 2) for c in _counter_cols(f"s{g}_", f"gender{g}_")]
_COUNTERS_SQL = with_views("SELECT " + ", ".join(_COUNTER_OUT) + " FROM counters", "counters")


@register("post_counters", _COUNTERS_SQL, ["play_dur"] + [f"gender{g}_play_dur" for g in (0, 1, 2)])
def q_post_counters(spark: SparkSession, d: str) -> DataFrame:
    pc = post_counters(counters_from_columns(X.counters(spark, d)))
    flat = [F.col(f"gender.gender{g}.{f}").alias(f"gender{g}_{f}") for g in (0, 1, 2) for f in COUNTER_FIELDS]
    return pc.select("pid", *COUNTER_FIELDS, *flat)


# ---------------------------------------------------------------- partition standard gate
_GATE_SQL = with_views("""
SELECT pid, ptype, part2_id, download_rate, like_rate,
       coalesce((download_rate >= th_d AND like_rate >= th_l) OR (download_rate >= 9 AND like_rate >= 9)
                OR (ptype <> 5 AND download_rate >= 9), false) AS meets_standard
FROM (SELECT r.*, CASE WHEN s.key IS NULL THEN 9.0 ELSE least(floor(coalesce(s.download_rate, 9.0)), 20.0) END AS th_d,
                  CASE WHEN s.key IS NULL THEN 9.0 ELSE least(floor(coalesce(s.like_rate, 9.0)), 20.0) END AS th_l
      FROM r LEFT JOIN (SELECT * FROM standard WHERE pcnt >= 10) s
        ON s.key = CASE WHEN r.ptype = 5 THEN 'video_' || CAST(r.part2_id AS VARCHAR) ELSE 'img' END) z""",
    "counters", "pool", "tax", "standard", extra=["""r AS (
SELECT c.pid, p.ptype, coalesce(t.part2_id, 72) AS part2_id,
       1000 * c.download / (1 + c.rec) AS download_rate, 1000 * c."like" / (1 + c.rec) AS like_rate
FROM counters c JOIN pool p ON p.pid = c.pid LEFT JOIN tax t ON t.tid = p.tid)"""])


def standard_rates(spark: SparkSession, d: str) -> DataFrame:
    c = X.counters(spark, d)
    p = X.pool(spark, d).select("pid", "ptype", "tid")
    t = X.taxonomy(spark, d).select("tid", "part2_id")
    j = c.join(p, "pid", "inner").join(t, "tid", "left")
    return j.select(
        "pid", "ptype", F.coalesce(F.col("part2_id"), F.lit(72)).cast("bigint").alias("part2_id"),
        (1000 * F.col("download") / (1 + F.col("rec"))).alias("download_rate"),
        (1000 * F.col("like") / (1 + F.col("rec"))).alias("like_rate"),
    )


@register("post_standard_gate", _GATE_SQL, ["download_rate", "like_rate"])
def q_post_standard_gate(spark: SparkSession, d: str) -> DataFrame:
    return post_standard_gate(standard_rates(spark, d), X.post_standard(spark, d))
