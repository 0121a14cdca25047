"""DuckDB oracle SQL for the hot-ranking family (cells, bounds, norms, ranks, index)."""

from __future__ import annotations

from .fixture_sql import AS_OF

# FIXED VALUES, written out here and not taken from the operators: a wrong one there must show.
HOT_SINCE_DAY, BEHAVIOUR_SINCE_DAY = "20010807", "19980101"
NORM_NAME = {
    "ctr": "sume_norm", "like_rate": "like_norm", "share_rate": "share_norm", "download_rate": "download_norm",
    "dur": "dur_norm", "detail_dur": "detail_dur_norm", "play_rate": "play_rate_norm", "play_video": "play_video_norm",
    "view_img": "view_img_norm", "review_rate": "review_rate_norm", "like_review_rate": "like_review_rate_norm",
    "review_get_rate": "review_get_rate_norm", "detail": "detail_norm", "comment_dur": "comment_dur_norm",
}
_VIDEO_METRICS = ("ctr", "like_rate", "share_rate", "download_rate", "dur", "detail_dur", "play_rate", "play_video",
                  "review_rate", "like_review_rate", "review_get_rate", "detail", "comment_dur")
_IMG_METRICS = ("ctr", "like_rate", "share_rate", "download_rate", "dur", "detail_dur", "view_img",
                "review_rate", "like_review_rate", "review_get_rate", "detail", "comment_dur")
VIDEO_FENCES = {m: (1.5, 1.0 if m in ("ctr", "play_rate") else 1.5) for m in _VIDEO_METRICS}
IMG_FENCES = {m: (1.5, 1.5) for m in _IMG_METRICS}
VIDEO_OUT_NORMS = tuple(NORM_NAME[m] for m in _VIDEO_METRICS)
IMG_OUT_NORMS = tuple(NORM_NAME[m] for m in _IMG_METRICS)
VIDEO_WEIGHTS = {"sume_norm": 0.32, "like_norm": 0.2, "share_norm": 0.2, "download_norm": 0.2, "dur_norm": 0.3,
                 "detail_dur_norm": 0.2, "play_rate_norm": 0.3, "play_video_norm": 0.3, "review_rate_norm": 0.4, "detail_norm": 0.4}
IMG_WEIGHTS = {"sume_norm": 0.34, "like_norm": 0.2, "share_norm": 0.2, "download_norm": 0.2, "dur_norm": 0.2,
               "detail_dur_norm": 0.2, "review_rate_norm": 0.4, "detail_norm": 0.4}

CELL_KEYS = ("ptype", "part2_id", "group_age", "group_gender")

_AGGS = [
    ("ctr", "CASE WHEN a.play_video_dur >= 5 OR a.stay_img_dur >= 2 OR a.view_img > 0 THEN 1 ELSE 0 END"),
    ("share_rate", "CASE WHEN a.share > 0 THEN 1 ELSE 0 END"),
    ("download_rate", "CASE WHEN a.download > 0 THEN 1 ELSE 0 END"),
    ("dur", f"CASE WHEN a.stay_time > 300 THEN 300 ELSE a.stay_time END"),
    ("like_rate", 'a."like"'),
    ("detail", "a.detail_post"),
    ("detail_dur", f"CASE WHEN a.detail_post_dur > 600 THEN 600 ELSE a.detail_post_dur END"),
    ("play_video_dur", f"CASE WHEN a.play_video_dur > 300 THEN 300 ELSE a.play_video_dur END"),
    ("review_rate", "CASE WHEN a.create_review + a.reply_review > 2 THEN 2 ELSE a.create_review + a.reply_review END"),
    ("review_get_rate", "a.reviews_review"),
    ("like_review_rate", "a.like_review"),
    ("view_img_dur", f"CASE WHEN a.view_img_dur > 300 THEN 300 ELSE a.view_img_dur END"),
    ("view_img", "a.view_img"),
    ("play_video", "CASE WHEN a.play_video_dur > 5 THEN 1 ELSE 0 END"),
    ("comment_dur", f"CASE WHEN a.view_comment_dur > 600 THEN 600 ELSE a.view_comment_dur END"),
]

CELL_DOUBLES = [n for n, _ in _AGGS] + ["play_rate"]


_DURATIONS = {"dur", "detail_dur", "play_video_dur", "view_img_dur", "comment_dur"}


def cells_cte(since_day: str = HOT_SINCE_DAY) -> str:
    def agg(n: str, e: str) -> str:
        if n in _DURATIONS:   # whole microseconds, summed exactly
            return f"CAST(sum(CAST(floor(({e}) * 1000000.0 + 0.5) AS BIGINT)) AS DOUBLE) / 1000000.0 / (sum(a.expose) + 200) AS {n}"
        return f"CAST(sum({e}) AS DOUBLE) / (sum(a.expose) + 200) AS {n}"

    aggs = ",\n       ".join(agg(n, e) for n, e in _AGGS)
    return f"""cells0 AS (
SELECT a.pid, CAST(coalesce(d.part2_id, 72) AS BIGINT) AS part2_id, CAST(coalesce(c.age, 0) AS BIGINT) AS group_age,
       CAST(coalesce(c.gender, 0) AS BIGINT) AS group_gender,
       CAST(CASE WHEN a.ptype <> 5 THEN 2 ELSE a.ptype END AS BIGINT) AS ptype,
       max(CASE WHEN b.vdur > 0 THEN b.vdur ELSE a.vdur END) AS vdur,
       CAST(sum(a.expose) AS BIGINT) AS expose,
       {aggs}
FROM ups a
JOIN pool e ON a.pid = e.pid
LEFT JOIN posts b ON a.pid = b.pid
LEFT JOIN users c ON a.mid = c.mid
LEFT JOIN tax d ON b.tid = d.tid
WHERE a.expose >= 1 AND a.ymd >= '{BEHAVIOUR_SINCE_DAY}'
  AND strftime(make_timestamp(e.ct * 1000000), '%Y%m%d') >= '{since_day}'
  AND e.review_cnt >= 20 AND e.pid IS NOT NULL AND e.rec >= 1000
  AND ((e.ctr >= 0.3 AND a.ptype <> 5) OR (e.ctr >= 0.4 AND a.ptype = 5))
  AND e.review_cnt / e.rec >= 0.001
GROUP BY 1, 2, 3, 4, 5
),
cells AS (
SELECT *, play_video_dur / (CASE WHEN vdur < 10 AND vdur > 0 THEN 10 WHEN vdur = 0 THEN 900 ELSE coalesce(vdur, 900) END) AS play_rate
FROM cells0
)"""


def sketch_bounds_select(src: str, fences: dict, probs: tuple[float, float] = (0.15, 0.95)) -> str:
    """Bounds per cell from the values at rank ceil(p * n)."""
    keys = ", ".join(CELL_KEYS)
    ranked = ", ".join(f"{m}, row_number() OVER (PARTITION BY {keys} ORDER BY {m} NULLS LAST) AS rn_{m}, "
                       f"count({m}) OVER (PARTITION BY {keys}) AS n_{m}" for m in fences)
    qs = ", ".join(f"max(CASE WHEN rn_{m} = greatest(1, ceil(round({p} * n_{m}, 7))) THEN {m} END) AS q{i}_{m}"
                   for m in fences for i, p in enumerate(probs))
    outs = []
    for m, (k_lo, k_hi) in fences.items():
        outs.append(f"CASE WHEN q0_{m} - {k_lo} * (q1_{m} - q0_{m}) > 0 THEN q0_{m} - {k_lo} * (q1_{m} - q0_{m}) ELSE 0 END AS {m}_min")
        outs.append(f"q1_{m} + {k_hi} * (q1_{m} - q0_{m}) AS {m}_max")
    return f"SELECT {keys}, {', '.join(outs)} FROM (SELECT {keys}, {qs} FROM (SELECT {keys}, {ranked} FROM {src}) r GROUP BY {keys}) q"


def bounds_select(src: str, fences: dict, probs: tuple[float, float] = (0.15, 0.95)) -> str:
    """Bounds per cell from explicit order statistics (linear interpolation between the two
    neighbouring values, or the value itself when they are equal)."""
    keys = ", ".join(CELL_KEYS)
    ranked = ", ".join(
        f"{m} * 100000 AS v_{m}, row_number() OVER (PARTITION BY {keys} ORDER BY {m} * 100000 NULLS LAST) AS rn_{m}, "
        f"count({m}) OVER (PARTITION BY {keys}) AS n_{m}"
        for m in fences
    )
    qs = []
    for m in fences:
        for i, p in enumerate(probs):
            h = f"(CAST({p} AS DOUBLE) * (n_{m} - 1))"
            v_lo = f"max(CASE WHEN rn_{m} = floor({h}) + 1 THEN v_{m} END)"
            v_hi = f"max(CASE WHEN rn_{m} = ceil({h}) + 1 THEN v_{m} END)"
            hh = f"max({h})"
            qs.append(f"CASE WHEN {v_lo} = {v_hi} THEN {v_lo} "
                      f"ELSE (ceil({hh}) - {hh}) * {v_lo} + ({hh} - floor({hh})) * {v_hi} END AS q{i}_{m}")
    outs = []
    for m, (k_lo, k_hi) in fences.items():
        lo, hi = f"(q0_{m} / 100000)", f"(q1_{m} / 100000)"
        mn = f"{lo} - {k_lo} * ({hi} - {lo})"
        outs.append(f"CASE WHEN {mn} > 0 THEN {mn} ELSE 0 END AS {m}_min")
        outs.append(f"{hi} + {k_hi} * ({hi} - {lo}) AS {m}_max")
    return f"""SELECT {keys},
       {", ".join(outs)}
FROM (SELECT {keys}, {", ".join(qs)}
      FROM (SELECT {keys}, {ranked} FROM {src}) r
      GROUP BY {keys}) s"""


def norm_select(src: str, bounds: str, metrics) -> str:
    on = " AND ".join(f"rg.{k} = st.{k}" for k in CELL_KEYS)
    norms = []
    for m in metrics:
        top = f"(CASE WHEN st.{m}_max > 0 THEN st.{m}_max ELSE 1 END)"
        n = f"coalesce((rg.{m} - st.{m}_min) / NULLIF({top} - st.{m}_min, 0), 0)"
        norms.append(f"CASE WHEN {n} > 1 THEN 1 WHEN {n} < 0 THEN 0 ELSE {n} END AS {NORM_NAME[m]}")
    return f"""SELECT rg.*, {", ".join(norms)}
FROM {src} rg LEFT JOIN {bounds} st ON {on}"""


def _all14(fences: dict, extra: tuple[str, ...]) -> dict:
    d = dict(fences)
    for m in extra:
        d[m] = (1.5, 1.5)
    return d


VIDEO_ALL = _all14(VIDEO_FENCES, ("view_img",))
IMG_ALL = _all14(IMG_FENCES, ("play_rate", "play_video"))


def rank_select(video: bool, src: str) -> str:
    weights = VIDEO_WEIGHTS if video else IMG_WEIGHTS
    score = " + ".join(f"{n} * {w}" for n, w in weights.items())
    cases = " ".join(
        f"WHEN group_gender = {g} AND group_age = {a} THEN ({score})" for g in (0, 1, 2) for a in (0, 1, 2, 3, 4)
    )
    norms = ", ".join(VIDEO_OUT_NORMS if video else IMG_OUT_NORMS)
    return f"""SELECT *, CAST(row_number() OVER (PARTITION BY group_gender, group_age, part2_id
                                   ORDER BY recall_score DESC NULLS LAST, pid) AS BIGINT) AS reviewed_rank
FROM (SELECT group_gender, group_age, part2_id, pid, round(CASE {cases} END, 4) AS recall_score, {norms}
      FROM {src}) z"""


def hot_ctes(video: bool) -> str:
    fences = VIDEO_FENCES if video else IMG_FENCES
    cond = "ptype = 5" if video else "ptype <> 5"
    return f"""typed AS (SELECT * FROM cells WHERE {cond}),
bounds AS ({bounds_select('typed', fences)}),
normed AS ({norm_select('typed', 'bounds', list(fences))})"""


__all__ = ["cells_cte", "bounds_select", "norm_select", "rank_select", "hot_ctes", "VIDEO_ALL", "IMG_ALL",
           "CELL_DOUBLES", "AS_OF"]
