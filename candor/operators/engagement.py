"""Engagement cells and outlier-robust normalisation.

``engagement_cells``  smoothed engagement rates per (post, partition, age, gender, type)
``robust_bounds``     p15/p95 outlier fences per (type, partition, age, gender) cell
``robust_norm``       (x - min) / (max - min) clipped to [0, 1], per cell

Plan shape at scale: the behaviour fact is filtered at the scan (ymd partition, expose),
joined to the pre-filtered candidate pool on ``pid``; post metadata is reduced to
the candidate pids by a semi join first; users are joined on ``mid``. The group-by is
partial-aggregated map-side, so a hot post or a hot cell does not land whole in one task. No
join is forced: adaptive execution broadcasts a side once it has measured that it is small
(the taxonomy, the bounds with one row per cell), and splits a skewed one otherwise.
"""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.scalars import capped, clip01, flag, play_rate_denominator

CELL_KEYS = ("ptype", "part2_id", "group_age", "group_gender")
MICROS = 1000000.0

# metric column -> name of its normalised column
NORM_NAME = {
    "ctr": "sume_norm", "like_rate": "like_norm", "share_rate": "share_norm",
    "download_rate": "download_norm", "dur": "dur_norm", "detail_dur": "detail_dur_norm",
    "play_rate": "play_rate_norm", "play_video": "play_video_norm", "view_img": "view_img_norm",
    "review_rate": "review_rate_norm", "like_review_rate": "like_review_rate_norm",
    "review_get_rate": "review_get_rate_norm", "detail": "detail_norm", "comment_dur": "comment_dur_norm",
}

# FIXED VALUES: metric -> (low fence multiplier, high fence multiplier), per post type
VIDEO_FENCES = {
    "ctr": (1.5, 1.0), "like_rate": (1.5, 1.5), "share_rate": (1.5, 1.5), "download_rate": (1.5, 1.5),
    "dur": (1.5, 1.5), "detail_dur": (1.5, 1.5), "play_rate": (1.5, 1.0), "play_video": (1.5, 1.5),
    "review_rate": (1.5, 1.5), "like_review_rate": (1.5, 1.5), "review_get_rate": (1.5, 1.5),
    "detail": (1.5, 1.5), "comment_dur": (1.5, 1.5),
}
IMG_FENCES = {
    "ctr": (1.5, 1.5), "like_rate": (1.5, 1.5), "share_rate": (1.5, 1.5), "download_rate": (1.5, 1.5),
    "dur": (1.5, 1.5), "detail_dur": (1.5, 1.5), "view_img": (1.5, 1.5), "review_rate": (1.5, 1.5),
    "like_review_rate": (1.5, 1.5), "review_get_rate": (1.5, 1.5), "detail": (1.5, 1.5),
    "comment_dur": (1.5, 1.5),
}


def day_start_epoch(ymd: str) -> int:
    """Epoch seconds of 00:00 UTC of a 'yyyyMMdd' day."""
    d = dt.datetime.strptime(ymd, "%Y%m%d")
    return calendar.timegm(d.timetuple())


def engagement_cells(
    behaviour: DataFrame,
    pool: DataFrame,
    posts: DataFrame,
    users: DataFrame,
    taxonomy: DataFrame,
    *,
    since_day: str,
    behaviour_since_day: str | None = "",
    min_review: int = C.HOT_MIN_REVIEW,
    min_rec: int = C.HOT_MIN_REC,
    min_ctr_img: float = C.HOT_MIN_CTR_IMG,
    min_ctr_video: float = C.HOT_MIN_CTR_VIDEO,
    min_review_ratio: float = C.HOT_MIN_REVIEW_RATIO,
    smoothing: int = C.SMOOTHING_EXPOSE,
    default_part2: int = C.DEFAULT_PART2,
) -> DataFrame:
    """Smoothed engagement per post x partition x age x gender x type.

    ``since_day`` bounds the pool's create day (``ymd(ct) >= since_day``);
    ``behaviour_since_day`` bounds the behaviour ``ymd`` (``""`` means same as
    ``since_day``, ``None`` means no bound).
    """
    if behaviour_since_day == "":
        behaviour_since_day = since_day
    b = behaviour.filter(F.col("expose") >= 1)
    if behaviour_since_day is not None:
        b = b.filter(F.col("ymd") >= F.lit(behaviour_since_day))
    b = b.select(
        "pid", "mid", "ptype", F.col("vdur").alias("a_vdur"), "expose", "play_video_dur", "stay_img_dur",
        "view_img", "share", "download", "stay_time", "like", "detail_post", "detail_post_dur",
        "create_review", "reply_review", "reviews_review", "like_review", "view_img_dur", "view_comment_dur",
    )
    # ymd(ct) >= since_day  <=>  ct >= epoch(since_day 00:00 UTC): a plain range, pushed to the scan.
    e = pool.filter(
        (F.col("ct") >= F.lit(day_start_epoch(since_day)))
        & (F.col("review_cnt") >= min_review)
        & F.col("pid").isNotNull()
        & (F.col("rec") >= min_rec)
        & (F.col("ctr") >= min(min_ctr_img, min_ctr_video))
        & (F.try_divide(F.col("review_cnt"), F.col("rec")) >= min_review_ratio)
    ).select("pid", F.col("ctr").alias("e_ctr"))

    j = b.join(e, "pid", "inner").filter(
        ((F.col("e_ctr") >= min_ctr_img) & (F.col("ptype") != C.VIDEO_PTYPE))
        | ((F.col("e_ctr") >= min_ctr_video) & (F.col("ptype") == C.VIDEO_PTYPE))
    )
    # Post metadata reduced to candidate pids before the join (pool side is small).
    pm = posts.select("pid", F.col("tid").alias("b_tid"), F.col("vdur").alias("b_vdur")).join(
        e.select("pid"), "pid", "left_semi"
    )
    j = j.join(pm, "pid", "left")
    j = j.join(users.select("mid", "age", "gender"), "mid", "left")
    tax = taxonomy.select(F.col("tid").alias("b_tid"), "part2_id")
    j = j.join(tax, "b_tid", "left")

    g = j.groupBy(
        "pid",
        F.coalesce(F.col("part2_id"), F.lit(default_part2)).cast("bigint").alias("part2_id"),
        F.coalesce(F.col("age"), F.lit(C.DEFAULT_AGE)).cast("bigint").alias("group_age"),
        F.coalesce(F.col("gender"), F.lit(C.DEFAULT_GENDER)).cast("bigint").alias("group_gender"),
        F.when(F.col("ptype") != C.VIDEO_PTYPE, F.lit(2)).otherwise(F.col("ptype")).cast("bigint").alias("ptype"),
    )
    den = F.sum("expose") + smoothing

    def rate(x: Column, name: str) -> Column:
        return (F.sum(x) / den).alias(name)

    def dur_rate(x: Column, name: str) -> Column:
        # Durations are summed as whole microseconds (bigint): exact, so the result does not
        # depend on how rows are split over partitions or the order partial sums are merged.
        micros = F.floor(x * MICROS + 0.5).cast("bigint")
        return (F.sum(micros) / MICROS / den).alias(name)

    cells = g.agg(
        F.max(F.when(F.col("b_vdur") > 0, F.col("b_vdur")).otherwise(F.col("a_vdur"))).alias("vdur"),
        F.sum("expose").alias("expose"),
        rate(flag((F.col("play_video_dur") >= 5) | (F.col("stay_img_dur") >= 2) | (F.col("view_img") > 0)), "ctr"),
        rate(flag(F.col("share") > 0), "share_rate"),
        rate(flag(F.col("download") > 0), "download_rate"),
        dur_rate(capped("stay_time", C.CAP_STAY_TIME), "dur"),
        rate(F.col("like"), "like_rate"),
        rate(F.col("detail_post"), "detail"),
        dur_rate(capped("detail_post_dur", C.CAP_DETAIL_DUR), "detail_dur"),
        dur_rate(capped("play_video_dur", C.CAP_PLAY_VIDEO_DUR), "play_video_dur"),
        rate(capped(F.col("create_review") + F.col("reply_review"), C.CAP_REVIEW), "review_rate"),
        rate(F.col("reviews_review"), "review_get_rate"),
        rate(F.col("like_review"), "like_review_rate"),
        dur_rate(capped("view_img_dur", C.CAP_VIEW_IMG_DUR), "view_img_dur"),
        rate(F.col("view_img"), "view_img"),
        rate(flag(F.col("play_video_dur") > 5), "play_video"),
        dur_rate(capped("view_comment_dur", C.CAP_COMMENT_DUR), "comment_dur"),
    )
    return cells.withColumn("play_rate", F.col("play_video_dur") / play_rate_denominator("vdur"))


def exact_quantiles(
    df: DataFrame,
    keys: tuple[str, ...] | list[str],
    metrics: list[str],
    probs: tuple[float, ...],
    *,
    scale: float = 1.0,
) -> DataFrame:
    """Exact linear-interpolation quantiles per group without holding a group in one task.

    The metrics are unpivoted to (keys, metric, value) rows, numbered within each
    (keys, metric) by ``skew_safe_row_number`` (a range-partitioned sort, so a hot group is
    spread over many tasks), and for each probability the two neighbouring order statistics
    are picked and interpolated exactly as Spark's ``percentile`` does:
    ``(hi - h) * v[lo] + (h - lo) * v[hi]`` with ``h = p * (n - 1)``, and ``v[lo]`` itself
    when the two neighbours are equal. NULLs are ignored.
    Returns keys + one ``array<double>`` column ``__q_<metric>`` (quantiles in ``probs`` order).
    """
    from .skew import skew_safe_row_number

    keys = list(keys)
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), (F.col(m).cast("double") * scale).alias("v")) for m in metrics])
    long = df.select(*keys, F.explode(cells).alias("__s")).select(*keys, "__s.metric", "__s.v").filter(F.col("v").isNotNull())
    ranked = skew_safe_row_number(long, keys + ["metric"], [F.col("v").asc()], name="rn")
    sizes = long.groupBy(*keys, "metric").agg(F.count(F.lit(1)).alias("n"))
    targets = []
    for i, p in enumerate(probs):
        h = F.lit(float(p)) * (F.col("n") - 1)
        targets.append(F.struct(F.lit(i).alias("i"), h.alias("h"), (F.floor(h) + 1).alias("lo"), (F.ceil(h) + 1).alias("hi")))
    t = sizes.select(*keys, "metric", F.explode(F.array(*targets)).alias("t")).select(*keys, "metric", "t.*")
    # one row per group x metric x probability
    pos = t.select(*keys, "metric", "i", F.col("lo").alias("rn")).unionByName(t.select(*keys, "metric", "i", F.col("hi").alias("rn")))
    picked = ranked.join(pos.distinct(), keys + ["metric", "rn"], "inner")
    lo_v = picked.select(*keys, "metric", "i", F.col("rn").alias("lo"), F.col("v").alias("v_lo"))
    hi_v = picked.select(*keys, "metric", "i", F.col("rn").alias("hi"), F.col("v").alias("v_hi"))
    q = t.join(lo_v, keys + ["metric", "i", "lo"]).join(hi_v, keys + ["metric", "i", "hi"])
    frac_lo = F.col("hi") - 1 - F.col("h")
    frac_hi = F.col("h") - (F.col("lo") - 1)
    # equal neighbours give the value itself (interpolating a*v + b*v can be 1 ulp off v)
    val = F.when((F.col("lo") == F.col("hi")) | (F.col("v_lo") == F.col("v_hi")), F.col("v_lo")).otherwise(
        frac_lo * F.col("v_lo") + frac_hi * F.col("v_hi"))
    per = q.groupBy(*keys, "metric").agg(F.sort_array(F.collect_list(F.struct("i", val.alias("q")))).alias("__qs"))
    per = per.select(*keys, "metric", F.transform("__qs", lambda x: x["q"]).alias("qs"))
    return per.groupBy(*keys).pivot("metric", list(metrics)).agg(F.first("qs")).select(
        *keys, *[F.col(m).alias(f"__q_{m}") for m in metrics]
    )


def robust_bounds(
    cells: DataFrame,
    fences: dict[str, tuple[float, float]],
    *,
    video_fences: dict[str, tuple[float, float]] | None = None,
    keys: tuple[str, ...] = CELL_KEYS,
    p_lo: float = C.P_LO,
    p_hi: float = C.P_HI,
    scale: int = C.PERCENTILE_SCALE,
    accuracy: int = 10000,
    approx: bool = False,
    quantiles: DataFrame | None = None,
) -> DataFrame:
    """One row per cell: ``<m>_min`` (floored at 0) and ``<m>_max`` for every metric.

    min = p_lo - k_lo * (p_hi - p_lo);  max = p_hi + k_hi * (p_hi - p_lo), percentiles of
    ``x * scale`` divided back by ``scale``. Percentiles are exact (``exact_quantiles``: no cell is
    ever held in one task), or with ``approx`` the bounded-memory ``percentile_approx`` sketch.
    ``quantiles`` (``sketches.merged_quantiles`` at the two percentiles) takes their place; ``cells`` isn't read then.
    With ``video_fences``, cells of video posts take their multipliers from there, so one pass
    serves both types (``ptype`` is a cell key).
    """
    metrics = list(fences)
    if quantiles is not None:
        s, scale = quantiles, 1
    elif approx:
        probs = F.array(F.lit(p_lo), F.lit(p_hi))
        s = cells.groupBy(*keys).agg(*[F.percentile_approx(F.col(m) * scale, probs, accuracy).alias(f"__q_{m}") for m in metrics])
    else:
        s = exact_quantiles(cells, keys, metrics, (p_lo, p_hi), scale=float(scale))

    def multiplier(m: str, side: int) -> Column:
        k = F.lit(fences[m][side])
        if video_fences is None or video_fences[m][side] == fences[m][side]:
            return k
        return F.when(F.col("ptype") == C.VIDEO_PTYPE, F.lit(video_fences[m][side])).otherwise(k)

    out = [F.col(k) for k in keys]
    for m in metrics:
        lo = F.col(f"__q_{m}")[0] / scale
        hi = F.col(f"__q_{m}")[1] / scale
        mn = lo - multiplier(m, 0) * (hi - lo)
        out.append(F.when(mn > 0, mn).otherwise(F.lit(0.0)).alias(f"{m}_min"))
        out.append((hi + multiplier(m, 1) * (hi - lo)).alias(f"{m}_max"))
    return s.select(*out)


def robust_norm(
    cells: DataFrame,
    bounds: DataFrame,
    metrics: list[str] | tuple[str, ...],
    *,
    keys: tuple[str, ...] = CELL_KEYS,
) -> DataFrame:
    """Attach ``<norm>`` = clip01(coalesce((x-min)/nullif(max'-min, 0), 0)), max' = max>0 ? max : 1.

    ``bounds`` has one row per cell.
    """
    j = cells.join(bounds, list(keys), "left")
    out = [F.col(c) for c in cells.columns]
    for m in metrics:
        mn, mx = F.col(f"{m}_min"), F.col(f"{m}_max")
        top = F.when(mx > 0, mx).otherwise(F.lit(1.0))
        n = F.coalesce((F.col(m) - mn) / F.nullif(top - mn, F.lit(0.0)), F.lit(0.0))
        out.append(clip01(n).alias(NORM_NAME[m]))
    return j.select(*out)
