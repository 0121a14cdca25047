"""Engagement cells from daily partial sums: a window merges its days instead of rescanning the fact.

``daily_partials`` reduces a day of behaviour to whole-number sums per post, partition, age, gender and type
(durations in whole microseconds), so sums of days are exact whatever their order. ``cells_from_partials`` adds up a
window of them and applies the pool's filters, which are the window's own: a post's pool row counts as it is when the
window is merged. Users and posts count as they were when their day was reduced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.scalars import capped, flag, play_rate_denominator
from .engagement import MICROS, day_start_epoch

KEYS = ("pid", "part2_id", "group_age", "group_gender", "ptype")


def _micros(x: Column) -> Column:
    return F.floor(x * MICROS + 0.5).cast("bigint")


def _sums() -> dict[str, Column]:
    """Rate -> what is summed for it in whole numbers."""
    return {
        "ctr": flag((F.col("play_video_dur") >= 5) | (F.col("stay_img_dur") >= 2) | (F.col("view_img") > 0)),
        "share_rate": flag(F.col("share") > 0), "download_rate": flag(F.col("download") > 0),
        "dur": _micros(capped("stay_time", C.CAP_STAY_TIME)), "like_rate": F.col("like"), "detail": F.col("detail_post"),
        "detail_dur": _micros(capped("detail_post_dur", C.CAP_DETAIL_DUR)), "play_video_dur": _micros(capped("play_video_dur", C.CAP_PLAY_VIDEO_DUR)),
        "review_rate": capped(F.col("create_review") + F.col("reply_review"), C.CAP_REVIEW), "review_get_rate": F.col("reviews_review"),
        "like_review_rate": F.col("like_review"), "view_img_dur": _micros(capped("view_img_dur", C.CAP_VIEW_IMG_DUR)), "view_img": F.col("view_img"),
        "play_video": flag(F.col("play_video_dur") > 5), "comment_dur": _micros(capped("view_comment_dur", C.CAP_COMMENT_DUR)),
    }


IN_MICROS = ("dur", "detail_dur", "play_video_dur", "view_img_dur", "comment_dur")


def daily_partials(behaviour: DataFrame, posts: DataFrame, users: DataFrame, taxonomy: DataFrame, *, default_part2: int = C.DEFAULT_PART2) -> DataFrame:
    """(ymd, the keys of a cell, vdur, expose, one whole-number sum a rate) of every day in ``behaviour``."""
    b = behaviour.filter(F.col("expose") >= 1).withColumnRenamed("vdur", "a_vdur")
    j = b.join(posts.select("pid", F.col("tid").alias("b_tid"), F.col("vdur").alias("b_vdur")), "pid", "left")
    j = j.join(users.select("mid", "age", "gender"), "mid", "left").join(taxonomy.select(F.col("tid").alias("b_tid"), "part2_id"), "b_tid", "left")
    g = j.groupBy(
        "ymd", "pid", F.coalesce("part2_id", F.lit(default_part2)).cast("bigint").alias("part2_id"),
        F.coalesce("age", F.lit(C.DEFAULT_AGE)).cast("bigint").alias("group_age"), F.coalesce("gender", F.lit(C.DEFAULT_GENDER)).cast("bigint").alias("group_gender"),
        F.when(F.col("ptype") != C.VIDEO_PTYPE, F.lit(2)).otherwise(F.col("ptype")).cast("bigint").alias("ptype"))
    return g.agg(F.max(F.when(F.col("b_vdur") > 0, F.col("b_vdur")).otherwise(F.col("a_vdur"))).alias("vdur"), F.sum("expose").alias("expose"),
                 *[F.sum(x).cast("bigint").alias(f"sum_{name}") for name, x in _sums().items()])


def write_partials(partials: DataFrame, path: str, *, period: str = "ymd", spread: int = 8) -> None:
    """Partials by ``period`` (a SQL expression over ymd; its day by default), replacing those periods that ``partials`` holds and no others.

    A period's rows go to ``spread`` tasks, so a busy day is not written by one.
    """
    p = partials.withColumn("period", F.expr(period))
    p = p.repartition("period", F.pmod(F.xxhash64("pid"), F.lit(spread)))
    p.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)


def cells_from_partials(
    partials: DataFrame, pool: DataFrame, *, since_day: str, behaviour_since_day: str, min_review: int = C.HOT_MIN_REVIEW, min_rec: int = C.HOT_MIN_REC,
    min_ctr_img: float = C.HOT_MIN_CTR_IMG, min_ctr_video: float = C.HOT_MIN_CTR_VIDEO, min_review_ratio: float = C.HOT_MIN_REVIEW_RATIO,
    smoothing: int = C.SMOOTHING_EXPOSE,
) -> DataFrame:
    """The rows of ``engagement.engagement_cells`` over the days since ``behaviour_since_day``."""
    e = pool.filter(
        (F.col("ct") >= F.lit(day_start_epoch(since_day))) & (F.col("review_cnt") >= min_review) & F.col("pid").isNotNull() & (F.col("rec") >= min_rec)
        & (F.col("ctr") >= min(min_ctr_img, min_ctr_video)) & (F.try_divide(F.col("review_cnt"), F.col("rec")) >= min_review_ratio)
    ).select("pid", F.col("ctr").alias("e_ctr"))
    j = partials.filter(F.col("ymd") >= F.lit(behaviour_since_day)).join(e, "pid").filter(
        ((F.col("e_ctr") >= min_ctr_img) & (F.col("ptype") != C.VIDEO_PTYPE)) | ((F.col("e_ctr") >= min_ctr_video) & (F.col("ptype") == C.VIDEO_PTYPE)))
    names = list(_sums())
    g = j.groupBy(*KEYS).agg(F.max("vdur").alias("vdur"), F.sum("expose").alias("expose"), *[F.sum(f"sum_{n}").alias(n) for n in names])
    den = F.col("expose") + smoothing
    rate = lambda n: (F.col(n) / MICROS / den if n in IN_MICROS else F.col(n) / den).alias(n)
    cells = g.select(*KEYS, "vdur", "expose", *[rate(n) for n in names])
    return cells.withColumn("play_rate", F.col("play_video_dur") / play_rate_denominator("vdur"))
