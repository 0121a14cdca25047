"""Registered cold-start queries and their DuckDB oracles."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .. import constants as C
from ..operators import boot as B
from ..session import set_down
from ..sources import fixtures as X
from .fixture_sql import with_views
from .params import AS_OF, BOOT_DAYS
from .registry import register

RULES = B.load_rules()
SINCE = AS_OF - BOOT_DAYS * C.DAY
_MOVER_OUT = ", ".join(str(x) for x in C.MOVER_EXCLUDED_PARTS)

# ---------------------------------------------------------------- SQL building blocks
_CAND_CTES = [
    f"""d AS (
SELECT p.pid, p.ptype, p.ct, p.rec_t, p.tid, p.gid, p.vdur,
       CASE WHEN p.pid % 5 <> 0 THEN 'src' || CAST(p.pid % 5 AS VARCHAR) ELSE '' END AS source, p.mid, p.rec, p.mover_level, p.mover_part_id,
       p.resource_status, p.subarea_status, p.n_subarea_types,
       CAST(coalesce(t.part1_id, 0) AS BIGINT) AS part1_id, CAST(coalesce(t.part2_id, 0) AS BIGINT) AS part2_id,
       CASE WHEN p.rec_t - p.ct > 3600 AND o.pid IS NOT NULL THEN coalesce(o.step_boot, 0) ELSE p.step_boot END AS step_boot,
       CASE WHEN p.rec_t - p.ct > 3600 AND o.pid IS NOT NULL THEN coalesce(o.step_boot_t, 0) ELSE p.step_boot_t END AS step_boot_t,
       CASE WHEN p.rec_t - p.ct > 3600 AND o.pid IS NOT NULL THEN coalesce(o.mover_support, 0) ELSE p.mover_support END AS mover_support
FROM pool p LEFT JOIN tax t ON t.tid = p.tid LEFT JOIN step_override o ON o.pid = p.pid
WHERE p.ct > {SINCE} AND p.rec_t > {SINCE} AND p.status >= 2)""",
    """top1 AS (SELECT gid, pid AS t1_pid, rec AS t1_rec FROM (
  SELECT gid, pid, rec, row_number() OVER (PARTITION BY gid ORDER BY rec DESC, pid DESC) AS rn FROM pool) z WHERE rn = 1)""",
    """top2 AS (SELECT p.gid, max(p.rec) AS t2 FROM pool p JOIN top1 ON top1.gid = p.gid WHERE p.pid <> top1.t1_pid GROUP BY p.gid)""",
    f"""cands AS (
SELECT d.pid, d.ptype, d.ct, d.rec_t, d.tid, d.gid, d.vdur, d.source, CAST(d.step_boot AS BIGINT) AS step_boot,
       CAST(d.step_boot_t AS BIGINT) AS step_boot_t, d.rec, d.mid,
       CAST(d.mover_level > 0 AND d.mover_part_id NOT IN ({_MOVER_OUT}) AS BIGINT) AS is_mover,
       CAST(d.mover_support AS BIGINT) AS mover_support, d.part1_id, d.part2_id
FROM d LEFT JOIN top1 ON top1.gid = d.gid LEFT JOIN top2 ON top2.gid = d.gid
WHERE d.part2_id <> 80 AND d.resource_status <> -20
  AND NOT (d.subarea_status > 0 AND d.n_subarea_types > 0 AND d.step_boot % 10 = 0)
  AND d.gid <> 0
  AND NOT (coalesce(CASE WHEN d.pid = top1.t1_pid THEN top2.t2 ELSE top1.t1_rec END >= 10000, false)
           AND d.step_boot >= 10))""",
]
_FEAT_CTE = f"""feats AS (
SELECT c.pid, c.ptype, c.rec AS pool_rec, CAST(coalesce(k.rec, 0) AS BIGINT) AS rec, CAST(coalesce(c.vdur, 0) AS BIGINT) AS vdur,
       CAST(coalesce(k.sume, 0) AS BIGINT) AS sume, CAST(coalesce(k.gsume, 0) AS BIGINT) AS gsume,
       CAST(coalesce(k.download, 0) AS BIGINT) AS download, CAST(coalesce(k."like", 0) AS BIGINT) AS "like",
       CAST(coalesce(k.share, 0) AS BIGINT) AS share, CAST(coalesce(k.review, 0) AS BIGINT) AS review,
       CAST(coalesce(k.detail, 0) AS BIGINT) AS detail,
       CASE WHEN coalesce(k.rec, 0) <> 0 THEN k.sume / k.rec ELSE 0.0 END AS ctr,
       CASE WHEN c.ptype = 5 AND coalesce(k.play_video, 0) > 0 AND coalesce(c.vdur, 0) > 0
            THEN (k.play_dur / 1000.0) / k.play_video / c.vdur ELSE 0.0 END AS play_rate,
       CASE WHEN c.ptype = 5 AND coalesce(k.play_video, 0) > 0 THEN (k.play_dur / 1000.0) / k.play_video ELSE 0.0 END AS avg_play_dur,
       CASE WHEN coalesce(k.rec, 0) <> 0 THEN k.download / k.rec ELSE 0.0 END AS download_rate,
       CASE WHEN coalesce(k.rec, 0) <> 0 THEN k."like" / k.rec ELSE 0.0 END AS like_rate,
       CAST({AS_OF} AS BIGINT) AS t, c.ct, c.step_boot_t, c.step_boot, c.mid, c.is_mover, c.mover_support,
       c.part1_id, c.part2_id
FROM cands c LEFT JOIN counters k ON k.pid = c.pid)"""
_FEAT2_CTE = """feats2 AS (
SELECT * REPLACE (CAST(CASE WHEN ptype = 5 AND avg_play_dur >= 10 AND play_rate >= 0.2 THEN 1
                          WHEN ptype = 5 AND avg_play_dur < 10 AND play_rate < 0.2 THEN -1 ELSE 0 END AS BIGINT) AS video_play_score)
FROM (SELECT *, 0 AS video_play_score FROM feats))"""
_FEAT_OUT = ("pid, ptype, pool_rec, rec, vdur, sume, gsume, download, \"like\", share, review, detail, ctr, play_rate, "
             "avg_play_dur, video_play_score, download_rate, like_rate, t, ct, step_boot_t, step_boot, mid, is_mover, "
             "mover_support, part1_id, part2_id")
_FEAT_DOUBLES = ["ctr", "play_rate", "avg_play_dur", "download_rate", "like_rate"]


def _duck_rule(text: str) -> str:
    return re.sub(r"\blike\b", '"like"', text)


def _rule_case() -> str:
    parts = []
    for t, steps in RULES.items():
        for s in steps:
            val = f"({_duck_rule(s['rule'])})" if s["rule"].strip() else "true"
            parts.append(f"WHEN kind = '{t}' AND step = {s['step']} THEN {val}")
    return "coalesce(CASE " + " ".join(parts) + " ELSE false END, false)"


_MATCH_CTE = f"""matched AS (
SELECT *, NOT m AND coalesce(is_mover = 1 AND ((step = 1 AND t - step_boot_t > 7800 AND t - step_boot_t <= 8100)
                                          OR (step = 2 AND t - step_boot_t > 43200 AND mover_support = 0)), false) AS rescued
FROM (SELECT *, {_rule_case()} AS m FROM (
        SELECT {_FEAT_OUT}, CASE WHEN ptype = 5 THEN 'video' ELSE 'img' END AS kind, step_boot // 10 AS step
        FROM feats2 WHERE step_boot % 10 = 0) a) b)"""


def _level_sql(cur: str, thr: list[int]) -> str:
    expr = str(len(thr))
    for i in range(len(thr) - 1, -1, -1):
        expr = f"CASE WHEN {cur} >= {thr[i]} THEN {expr} ELSE {i} END"
    return expr


def _at(thr: list[int], idx: str) -> str:
    return "CASE " + " ".join(f"WHEN {idx} = {i} THEN {v}" for i, v in enumerate(thr)) + " END"


_VT = [s["expose_to"] for s in RULES["video"]]
_IT = [s["expose_to"] for s in RULES["img"]]


def _by_type(ptype: str, fv: str, fi: str) -> str:
    return f"CASE WHEN {ptype} = 5 THEN {fv} ELSE {fi} END"


_LEFT_CTE = f"""lefts AS (
SELECT *, CAST(CASE WHEN step >= level THEN
                 CASE WHEN step > 0 THEN {_by_type('ptype', _at(_VT, 'step'), _at(_IT, 'step'))}
                                         - greatest(cur, {_by_type('ptype', _at(_VT, 'step - 1'), _at(_IT, 'step - 1'))})
                      ELSE {_by_type('ptype', _at(_VT, 'step'), _at(_IT, 'step'))} - cur END
               ELSE 0 END AS BIGINT) AS left_expose,
       CAST(CASE WHEN step < level THEN level * 10 END AS BIGINT) AS jump_to
FROM (SELECT *, CAST({_by_type('ptype', _level_sql('cur', _VT), _level_sql('cur', _IT))} AS BIGINT) AS level
      FROM (SELECT *, greatest(rec, coalesce(pool_rec, 0)) AS cur FROM matched WHERE m OR rescued) a) b)"""


def _weight_expr() -> str:
    def base(g):
        return f"CASE WHEN coalesce(k.s{g}_rec, 0) <> 0 THEN (k.s{g}_download + k.s{g}_like) / k.s{g}_rec ELSE 0.0 END"

    pv = lambda g: f"coalesce(k.s{g}_play_video, 0)"
    rec = lambda g: f"coalesce(k.s{g}_rec, 0)"
    play_branch = f"(coalesce(c.ptype, 0) = 5 OR {pv(1)} > 0 OR {pv(2)} > 0)"
    use_play = f"({play_branch} AND {pv(1)} > 0 AND {pv(2)} > 0)"
    use_sume = f"(NOT {play_branch} AND coalesce(c.ptype, 0) > 0 AND coalesce(c.ptype, 0) < 5 AND {rec(1)} > 0 AND {rec(2)} > 0)"

    def sc(g):
        return (f"CASE WHEN {use_play} THEN k.s{g}_play_dur / k.s{g}_play_video WHEN {use_sume} THEN k.s{g}_sume / k.s{g}_rec "
                f"ELSE {base(g)} END")

    return f"""SELECT pid, CASE WHEN s1 <> 0 AND s2 <> 0 THEN printf('%.4f', s1 / s2) || ':' || printf('%.4f', s2 / s1)
                 WHEN s1 > 0 AND s2 = 0 THEN '1.2:1.0'
                 WHEN s1 = 0 AND s2 > 0 THEN CASE WHEN r1 >= 20 THEN '0.8:1.5' ELSE '1.0:1.5' END
                 ELSE '1.0:1.0' END AS weight
FROM (SELECT c.pid, {sc(1)} AS s1, {sc(2)} AS s2, {rec(1)} AS r1 FROM {{src}} c LEFT JOIN counters k ON k.pid = c.pid) w"""


_VIEWS = ("pool", "tax", "step_override", "counters")
_BASE = _CAND_CTES + [_FEAT_CTE, _FEAT2_CTE]

# ---------------------------------------------------------------- registrations


def candidates(spark: SparkSession, d: str, docs: DataFrame | None = None) -> DataFrame:
    """Cold-start candidates over the fixture tables."""
    return B.boot_candidates(X.pool_docs(spark, d) if docs is None else docs, X.step_override(spark, d), X.taxonomy(spark, d),
                             as_of=AS_OF, days=BOOT_DAYS)


@register("boot_candidates", with_views("SELECT * FROM cands", *_VIEWS, extra=_CAND_CTES))
def q_boot_candidates(spark: SparkSession, d: str) -> DataFrame:
    return candidates(spark, d)


def features(spark: SparkSession, d: str) -> DataFrame:
    return B.boot_features(candidates(spark, d), X.counters(spark, d), as_of=AS_OF)


@register("boot_features", with_views(f"SELECT {_FEAT_OUT} FROM feats2", *_VIEWS, extra=_BASE), _FEAT_DOUBLES)
def q_boot_features(spark: SparkSession, d: str) -> DataFrame:
    return features(spark, d)


_MATCH_OUT = _FEAT_OUT + ", step, m AS matched, rescued"


@register("boot_rule_match", with_views(f"SELECT {_MATCH_OUT} FROM matched", *_VIEWS, extra=_BASE + [_MATCH_CTE]),
          _FEAT_DOUBLES)
def q_boot_rule_match(spark: SparkSession, d: str) -> DataFrame:
    return B.boot_rule_match(features(spark, d), RULES)


@register("boot_left_expose",
          with_views(f"SELECT {_MATCH_OUT}, level, left_expose, jump_to FROM lefts", *_VIEWS,
                     extra=_BASE + [_MATCH_CTE, _LEFT_CTE]), _FEAT_DOUBLES)
def q_boot_left_expose(spark: SparkSession, d: str) -> DataFrame:
    return B.boot_left_expose(B.boot_rule_match(features(spark, d), RULES), RULES)


@register("boot_gender_weight", with_views(_weight_expr().format(src="(SELECT pid, ptype FROM pool)"), "pool", "counters"))
def q_boot_gender_weight(spark: SparkSession, d: str) -> DataFrame:
    return B.boot_gender_weight(X.counters(spark, d), X.pool(spark, d).select("pid", "ptype"))


def transition_parts() -> tuple[list[str], str]:
    """CTEs and body of one round over the views pool, tax, step_override, counters and serving."""
    thr_at = lambda idx: _by_type("x.p_ptype", _at(_VT, idx), _at(_IT, idx))
    n_steps = _by_type("x.p_ptype", str(len(_VT)), str(len(_IT)))
    ctes = _BASE + [_MATCH_CTE, _LEFT_CTE, f"weights AS ({_weight_expr().format(src='cands')})", f"""
keys AS (SELECT pid FROM serving UNION SELECT pid FROM lefts)""", f"""
x0 AS (
SELECT k.pid, s.remaining AS s_rem, s.weight AS s_w, s.pid IS NOT NULL AS in_s,
       e.step AS e_step, coalesce(e.rescued, false) AS rescued, e.left_expose, e.jump_to,
       c.pid IS NOT NULL AS is_cand, w.weight,
       coalesce(p.step_boot, 0) AS p_step, p.step_boot_t AS p_t, p.mover_support AS p_ms, coalesce(p.ptype, 2) AS p_ptype,
       coalesce(p.rec, 0) AS p_rec, p.pid IS NOT NULL AS p_has,
       o.step_boot AS o_step, o.step_boot_t AS o_t, o.mover_support AS o_ms, o.real_step AS o_real,
       o.pid IS NOT NULL AS o_has, cn.rec AS c_rec
FROM keys k LEFT JOIN serving s ON s.pid = k.pid LEFT JOIN lefts e ON e.pid = k.pid LEFT JOIN cands c ON c.pid = k.pid
LEFT JOIN weights w ON w.pid = k.pid LEFT JOIN pool p ON p.pid = k.pid LEFT JOIN step_override o ON o.pid = k.pid
LEFT JOIN counters cn ON cn.pid = k.pid)""", f"""
x1 AS (
SELECT x0.*, jump_to IS NOT NULL AS jumped,
       CASE WHEN jump_to IS NOT NULL THEN jump_to ELSE p_step END AS s1,
       CASE WHEN jump_to IS NOT NULL THEN {AS_OF} ELSE p_t END AS t1,
       CASE WHEN jump_to IS NOT NULL THEN jump_to ELSE o_step END AS o1,
       CASE WHEN jump_to IS NOT NULL THEN {AS_OF} ELSE o_t END AS ot1,
       CASE WHEN jump_to IS NOT NULL THEN e_step * 10 ELSE o_real END AS oreal1
FROM x0)""", f"""
x2 AS (
SELECT x.*,
       (in_s AND s_rem <= 0)
       OR (in_s AND s_rem > 0 AND p_has AND (s1 // 10 >= {n_steps}
            OR {thr_at('s1 // 10')} - greatest(coalesce(c_rec, 0), p_rec) <= 0))
       OR (in_s AND s_rem > 0 AND NOT is_cand) AS finish,
       in_s AND s_rem > 0 AND p_has AND is_cand AND NOT (s1 // 10 >= {n_steps}
            OR coalesce({thr_at('s1 // 10')} - greatest(coalesce(c_rec, 0), p_rec) <= 0, false)) AS refresh
FROM x1 x)""", """
x3 AS (
SELECT *, finish AND p_has AND s1 % 10 = 5 AS fin_eff, coalesce(left_expose > 0, false) AS start FROM x2)""", f"""
x4 AS (
SELECT *,
       CASE WHEN fin_eff THEN s1 + 5 ELSE s1 END AS s2, CASE WHEN fin_eff THEN {AS_OF} ELSE t1 END AS t2,
       CASE WHEN fin_eff THEN coalesce(o1, 0) + 5 ELSE o1 END AS o2, CASE WHEN fin_eff THEN {AS_OF} ELSE ot1 END AS ot2
FROM x3)""", """
x5 AS (
SELECT *,
       CASE WHEN start THEN s2 + 5 ELSE s2 END AS s3,
       CASE WHEN start AND rescued THEN e_step ELSE p_ms END AS ms3,
       CASE WHEN start THEN coalesce(o2, 0) + 5 ELSE o2 END AS o3,
       CASE WHEN start AND rescued THEN e_step ELSE o_ms END AS oms3,
       jumped OR fin_eff OR start AS changed,
       concat_ws('+', CASE WHEN jumped THEN 'jump' END, CASE WHEN fin_eff THEN 'finish' END,
                 CASE WHEN start THEN 'start' END) AS reason
FROM x4)"""]
    body = """
SELECT 'serving' AS output, pid, CAST(CASE WHEN start THEN left_expose ELSE s_rem END AS BIGINT) AS remaining,
       CASE WHEN start OR refresh THEN weight ELSE s_w END AS weight, CAST(NULL AS BIGINT) AS step_boot,
       CAST(NULL AS BIGINT) AS step_boot_t, CAST(NULL AS BIGINT) AS mover_support, CAST(NULL AS BIGINT) AS real_step,
       '' AS reason
FROM x5 WHERE start OR (in_s AND NOT finish)
UNION ALL
SELECT 'pool', pid, NULL, NULL, CAST(s3 AS BIGINT), CAST(t2 AS BIGINT), CAST(ms3 AS BIGINT), NULL, reason FROM x5 WHERE changed
UNION ALL
SELECT 'override', pid, NULL, NULL, CAST(o3 AS BIGINT), CAST(ot2 AS BIGINT), CAST(oms3 AS BIGINT), CAST(oreal1 AS BIGINT), reason
FROM x5 WHERE changed"""
    return ctes, body


_TRANSITION_CTES, _TRANSITION_BODY = transition_parts()


@register("boot_transition", with_views(_TRANSITION_BODY, *_VIEWS, "serving", extra=_TRANSITION_CTES))
def q_boot_transition(spark: SparkSession, d: str) -> DataFrame:
    # each is read several times by the round
    docs = set_down(B.step_documents(X.pool_docs(spark, d)))
    cands = set_down(candidates(spark, d, docs))
    return B.boot_transition(cands, set_down(X.counters(spark, d)), X.serving_budget(spark, d), docs,
                             X.step_override(spark, d), RULES, as_of=AS_OF)


# A ladder whose rules divide without a guard of their own (posts with no exposure divide by zero).
UNGUARDED = """\
video:
  - { step: 0, expose_to: 200, rule: '' }
  - { step: 1, expose_to: 500, rule: 'download/rec > 0.008 or like >= 1' }
  - { step: 2, expose_to: 1000, rule: '(like + download)/(rec + 0) >= 0.05 and t-step_boot_t <= 7800' }
img:
  - { step: 0, expose_to: 100, rule: 'share/like < 2 or pool_rec/greatest(rec, review) > 1' }
  - { step: 1, expose_to: 200, rule: '(like+2*review)/rec>=0.015' }
  - { step: 2, expose_to: 500, rule: 'download/rec/download > 0' }
"""
_UNGUARDED_SQL = """
SELECT pid, step, coalesce(CASE
    WHEN ptype = 5 AND step = 0 THEN true
    WHEN ptype = 5 AND step = 1 THEN download / nullif(rec, 0) > 0.008 OR "like" >= 1
    WHEN ptype = 5 AND step = 2 THEN ("like" + download) / nullif(rec + 0, 0) >= 0.05 AND t - step_boot_t <= 7800
    WHEN ptype <> 5 AND step = 0 THEN share / nullif("like", 0) < 2 OR pool_rec / nullif(greatest(rec, review), 0) > 1
    WHEN ptype <> 5 AND step = 1 THEN ("like" + 2 * review) / nullif(rec, 0) >= 0.015
    WHEN ptype <> 5 AND step = 2 THEN download / nullif(rec, 0) / nullif(download, 0) > 0
  END, false) AS matched
FROM (SELECT *, step_boot // 10 AS step FROM feats2 WHERE step_boot % 10 = 0)"""


@register("boot_rule_unguarded", with_views(_UNGUARDED_SQL, *_VIEWS, extra=_BASE))
def q_boot_rule_unguarded(spark: SparkSession, d: str) -> DataFrame:
    return B.boot_rule_match(features(spark, d), B.load_rules(UNGUARDED)).select("pid", "step", "matched")
