"""The fixture views of ``candor.sources.fixtures`` written as DuckDB SQL CTEs.

``with_views(body, *names)`` prefixes ``body`` with the CTEs it needs (and their
dependencies) so each oracle query is one self-contained statement over the raw tables.
"""

from __future__ import annotations

AS_OF = 1004918400
EVENTS_AS_OF = 1706659200

_PTYPE = "CASE WHEN {k} % 3 = 0 THEN 5 ELSE 2 + {k} % 3 END"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "ups": ((), f"""
SELECT strftime(l.l_shipdate, '%Y%m%d') AS ymd, o.o_custkey AS mid, l.l_partkey AS pid,
       CAST({_PTYPE.format(k='l.l_partkey')} AS BIGINT) AS ptype, CAST(0 AS BIGINT) AS vdur,
       CAST(l.l_linenumber % 7 <> 0 AS BIGINT) AS expose,
       CAST(l.l_linenumber % 4 = 0 AS BIGINT) AS share,
       CAST(l.l_tax > 0.04 AS BIGINT) AS download,
       CAST(l.l_discount > 0.05 AS BIGINT) AS "like",
       CAST(l.l_linenumber % 2 AS BIGINT) AS view_img,
       CAST(l.l_linestatus = 'O' AS BIGINT) AS detail_post,
       CAST(l.l_linenumber % 3 AS BIGINT) AS create_review,
       CAST(l.l_returnflag = 'R' AS BIGINT) AS reply_review,
       CAST(l.l_linenumber % 2 AS BIGINT) AS reviews_review,
       CAST(l.l_linenumber % 5 = 0 AS BIGINT) AS like_review,
       l.l_extendedprice / 200 AS stay_time,
       l.l_quantity * 8 AS play_video_dur,
       CAST(l.l_linenumber % 4 AS DOUBLE) AS stay_img_dur,
       l.l_quantity * 10 AS view_img_dur,
       l.l_quantity * 20 AS detail_post_dur,
       l.l_quantity * 15 AS view_comment_dur
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    "users": ((), """
SELECT c_custkey AS mid, CAST(c_custkey % 5 AS BIGINT) AS age,
       CAST(CASE WHEN c_nationkey % 4 <> 3 THEN c_nationkey % 4 END AS BIGINT) AS gender
FROM customer"""),
    "tax": ((), """
SELECT CAST(n_nationkey AS BIGINT) AS tid, CAST(n_nationkey + 70 AS BIGINT) AS part2_id,
       CAST(n_regionkey + 13 AS BIGINT) AS part1_id
FROM nation"""),
    "post_agg": (("ups",), """
SELECT pid, count(*) AS n, sum(download) AS dl, sum("like") AS lk, sum(share) AS sh,
       sum(create_review + reply_review) AS rv,
       sum(CAST(play_video_dur >= 160 AS BIGINT)) AS hits, sum(play_video_dur) AS play_sum
FROM ups GROUP BY pid"""),
    "pool": (("post_agg",), f"""
SELECT p.p_partkey AS pid, CAST(p.p_partkey % 1009 + 1 AS BIGINT) AS mid, p.p_partkey % 27 AS tid, p.p_partkey // 4 AS gid,
       CAST({_PTYPE.format(k='p.p_partkey')} AS BIGINT) AS ptype,
       CAST(CASE WHEN p.p_partkey % 13 = 0 THEN 1 ELSE 2 END AS BIGINT) AS status,
       CAST({AS_OF} - (p.p_partkey % 200) * 86400 - 3600 AS BIGINT) AS ct,
       CAST({AS_OF} - (p.p_partkey % 200) * 86400 - 3600 + (p.p_partkey % 3) * 2400 AS BIGINT) AS rec_t,
       CAST(CASE WHEN p.p_partkey % 11 = 0 THEN 0 ELSE p.p_size END AS BIGINT) AS vdur,
       CAST(((p.p_partkey // 2) % 4) * 10 + CASE WHEN p.p_partkey % 7 = 0 THEN 5 ELSE 0 END AS BIGINT) AS step_boot,
       CAST({AS_OF} - [300, 1000, 5000, 7900, 8200, 50000][CAST((p.p_partkey // 8) % 6 AS INTEGER) + 1] AS BIGINT) AS step_boot_t,
       CAST(CASE WHEN p.p_partkey % 5 = 0 THEN 1040 WHEN p.p_partkey % 5 = 1 THEN 1050 ELSE 0 END AS BIGINT) AS community_tag,
       CAST(CASE WHEN p.p_partkey % 10 < 3 THEN 30 ELSE 0 END AS BIGINT) AS choice_status,
       CAST(CASE WHEN p.p_partkey % 31 <> 0 AND (p.p_partkey // 5) % 3 = 1 THEN 1 ELSE 0 END AS BIGINT) AS mover_level,
       CAST(CASE WHEN p.p_partkey % 31 <> 0 THEN p.p_partkey % 20 + 50 ELSE 0 END AS BIGINT) AS mover_part_id,
       CAST(CASE WHEN p.p_partkey % 17 = 0 THEN -20 ELSE 0 END AS BIGINT) AS resource_status,
       CAST(p.p_partkey % 2 AS BIGINT) AS subarea_status,
       CAST(CASE WHEN p.p_partkey % 23 = 1 THEN 1 ELSE 0 END AS BIGINT) AS n_subarea_types,
       CAST(CASE WHEN p.p_partkey % 29 = 0 THEN 12000
                 WHEN p.p_partkey % 200 < 30 THEN 2 * coalesce(a.n, 0)
                 ELSE 50 * coalesce(a.n, 0) END AS BIGINT) AS rec,
       CAST(coalesce(a.dl, 0) AS BIGINT) AS download,
       CAST(coalesce(a.lk, 0) AS BIGINT) AS "like",
       CAST(coalesce(a.rv, 0) AS BIGINT) AS review_cnt,
       CAST(coalesce(a.hits / a.n, 0.0) AS DOUBLE) AS ctr,
       CAST(0 AS BIGINT) AS mover_support
FROM part p LEFT JOIN post_agg a ON a.pid = p.p_partkey"""),
    "posts": (("pool",), "SELECT pid, tid, vdur, ct FROM pool"),
    "counters": (("ups", "users"), """
SELECT p.p_partkey AS pid,
       {blocks}
FROM part p
LEFT JOIN (
  SELECT u.pid, count(*) AS n, sum(u.download) AS dl, sum(u."like") AS lk, sum(u.share) AS sh,
         sum(u.create_review + u.reply_review) AS rv,
         sum(CAST(u.play_video_dur >= 160 AS BIGINT)) AS hits, sum(u.play_video_dur) AS play_sum,
         {gender_sums}
  FROM (SELECT x.*, coalesce(m.gender, 0) AS g FROM ups x LEFT JOIN users m ON x.mid = m.mid) u
  GROUP BY u.pid
) a ON a.pid = p.p_partkey
WHERE a.pid IS NOT NULL"""),
    "step_override": ((), f"""
SELECT p_partkey AS pid, CAST(10 AS BIGINT) AS step_boot, CAST({AS_OF} - 1000 AS BIGINT) AS step_boot_t,
       CAST(0 AS BIGINT) AS mover_support,
       CAST(CASE WHEN p_partkey % 3 <> 0 THEN (p_partkey % 3) * 10 END AS BIGINT) AS real_step
FROM part WHERE p_partkey % 4 = 2"""),
    "serving": ((), """
SELECT p_partkey AS pid, CAST((p_partkey // 7) % 3 AS BIGINT) AS remaining,
       CASE WHEN p_partkey % 5 <> 0 THEN '1.' || CAST(p_partkey % 5 AS VARCHAR) || ':0.9' END AS weight
FROM part WHERE p_partkey % 7 = 0"""),
    "standard": (("tax",), """
SELECT 'video_' || CAST(part2_id AS VARCHAR) AS key, CAST(part2_id % 20 AS BIGINT) AS pcnt,
       CAST(part2_id % 12 AS DOUBLE) AS download_rate, CAST(part2_id % 25 AS DOUBLE) AS like_rate
FROM tax
UNION ALL SELECT 'img', 50, 6.5, 8.5"""),
    "vectors": ((), "SELECT vec_id AS pid, CAST(label AS BIGINT) AS tid, embedding AS vector FROM embeddings"),
    "actions": ((), """
SELECT user_id AS mid, CAST(json_extract_string(props, '$.k') AS BIGINT) AS pid, ts, event_id, event_type
FROM events WHERE event_type <> 'error'"""),
    "exposures": ((), """
SELECT e.pid, e.user_id AS mid, e.ts, e.event_id, c.counter, CASE WHEN c.amount > 0 THEN c.amount ELSE e.pid * 100 END AS amount
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS pid FROM events) e
JOIN (VALUES ('view', 'rec', 1), ('view', 'play_video', 1), ('view', 'play_dur', 0),
             ('click', 'rec', 1), ('click', 'sume', 1), ('click', 'detail', 1),
             ('purchase', 'download', 1), ('purchase', 'gsume', 1),
             ('signup', 'like', 1), ('signup', 'review', 1), ('error', 'share', 1)) c(event_type, counter, amount)
  ON c.event_type = e.event_type"""),
    "recall_log": ((), """
SELECT user_id AS mid, CAST(json_extract_string(props, '$.k') AS BIGINT) AS pid,
       CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 AS source,
       CAST(1 AS BIGINT) AS exposed, CAST(event_type = 'click' AS BIGINT) AS clicked, ts
FROM events"""),
}


def _counter_sql() -> str:
    def block(prefix: str, sfx: str) -> list[str]:
        z = lambda c: f"coalesce(a.{c}{sfx}, 0)"
        m = "(1 + (p.p_partkey // 12) % 40)"
        return [
            f"CAST({m} * {z('n')} AS BIGINT) AS {prefix}rec",
            f"CAST({m} * {z('hits')} * 7 AS BIGINT) // 10 AS {prefix}sume",
            f"CAST(0 AS BIGINT) AS {prefix}gsume",
            f"CAST(0 AS BIGINT) AS {prefix}detail",
            f"CAST({z('sh')} AS BIGINT) AS {prefix}share",
            f"CAST({z('lk')} AS BIGINT) AS \"{prefix}like\"",
            f"CAST({z('dl')} * ((p.p_partkey // 7) % 3) AS BIGINT) AS {prefix}download",
            f"CAST({z('rv')} AS BIGINT) // 2 AS {prefix}review",
            f"CAST({z('n')} AS BIGINT) AS {prefix}play_video",
            f"CAST(coalesce(a.play_sum{sfx}, 0.0) * 1000 / 8 AS BIGINT) AS {prefix}play_dur",
        ]

    cols = block("", "")
    for g in (0, 1, 2):
        cols += block(f"s{g}_", str(g))
    sums = []
    for g in (0, 1, 2):
        w = f"u.g = {g}"
        sums += [
            f"sum(CASE WHEN {w} THEN 1 ELSE 0 END) AS n{g}",
            f"sum(CASE WHEN {w} THEN u.download ELSE 0 END) AS dl{g}",
            f"sum(CASE WHEN {w} THEN u.\"like\" ELSE 0 END) AS lk{g}",
            f"sum(CASE WHEN {w} THEN u.share ELSE 0 END) AS sh{g}",
            f"sum(CASE WHEN {w} THEN u.create_review + u.reply_review ELSE 0 END) AS rv{g}",
            f"sum(CASE WHEN {w} THEN CAST(u.play_video_dur >= 160 AS BIGINT) ELSE 0 END) AS hits{g}",
            f"sum(CASE WHEN {w} THEN u.play_video_dur ELSE 0.0 END) AS play_sum{g}",
        ]
    deps, body = VIEWS["counters"]
    VIEWS["counters"] = (deps, body.format(blocks=",\n       ".join(cols), gender_sums=",\n         ".join(sums)))
    return VIEWS["counters"][1]


_counter_sql()


def with_views(body: str, *names: str, extra: tuple[str, ...] | list[str] = ()) -> str:
    """Return ``WITH <needed CTEs>, <extra CTEs> <body>``; CTEs come out in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({VIEWS[n][1]}\n)" for n in order] + list(extra)
    if not parts:
        return body
    return "WITH " + ",\n".join(parts) + "\n" + body
