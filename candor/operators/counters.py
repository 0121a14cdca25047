"""Per-post live counters: parsing the raw string hash and the partition standard gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C

COUNTER_FIELDS = ("rec", "sume", "gsume", "detail", "share", "like", "download", "review", "play_video", "play_dur")


def counter_value(m: Column, key: str) -> Column:
    return F.coalesce(m[key].try_cast("bigint"), F.lit(0).cast("bigint"))


def _block(m: Column, prefix: str) -> list[Column]:
    cols = []
    for f in COUNTER_FIELDS:
        v = counter_value(m, prefix + f)
        if f == "play_dur":
            v = v / 1000  # milliseconds -> seconds
        cols.append(v.alias(f))
    return cols


def post_counters(raw: DataFrame, *, map_col: str = "m") -> DataFrame:
    """(pid, map<string,string>) -> (pid, totals..., gender struct<gender0, gender1, gender2>).

    Posts whose hash is empty are dropped (no counters yet); absent fields read as 0.
    ``play_dur`` is returned in seconds.
    """
    m = F.col(map_col)
    r = raw.filter(m.isNotNull() & (F.size(m) > 0))
    totals = _block(m, "")
    gender = F.struct(*[F.struct(*_block(m, f"s{g}_")).alias(f"gender{g}") for g in (0, 1, 2)])
    return r.select("pid", *totals, gender.alias("gender"))


def counters_from_columns(wide: DataFrame) -> DataFrame:
    """Wide counter table (rec, s0_rec, ...) -> the raw string-hash form ``(pid, m)``."""
    keys = [c for c in wide.columns if c != "pid"]
    kv = []
    for c in keys:
        kv += [F.lit(c), F.col(c).cast("string")]
    return wide.select("pid", F.create_map(*kv).alias("m"))


def post_standard_gate(
    rates: DataFrame,
    standards: DataFrame,
    *,
    min_pcnt: int = C.STANDARD_MIN_PCNT,
    default: float = C.STANDARD_DEFAULT,
    cap: float = C.STANDARD_CAP,
) -> DataFrame:
    """rates(pid, ptype, part2_id, download_rate, like_rate) -> + meets_standard.

    Key ``video_<part2>`` for video, ``img`` otherwise; standards with pcnt < 10 are ignored.
    Thresholds are ``min(floor(std), 20)``, 9.0 when there is no standard. Pass if both
    rates reach their thresholds, or both reach 9, or (non-video) download reaches 9.
    """
    s = standards.filter(F.col("pcnt") >= min_pcnt).select(
        F.col("key").alias("__key"),
        F.col("gender_standard.a.download_rate").alias("__sd"),
        F.col("gender_standard.a.like_rate").alias("__sl"),
        F.lit(True).alias("__has"),
    )
    key = F.when(F.col("ptype") == C.VIDEO_PTYPE, F.concat(F.lit("video_"), F.col("part2_id").cast("string"))).otherwise(
        F.lit("img")
    )
    j = rates.withColumn("__key", key).join(s, "__key", "left")

    def thr(c: str) -> Column:
        return F.when(
            F.col("__has").isNull(), F.lit(default)
        ).otherwise(F.least(F.floor(F.coalesce(F.col(c), F.lit(default))).cast("double"), F.lit(cap)))

    dl, lk = F.col("download_rate"), F.col("like_rate")
    meets = (
        ((dl >= thr("__sd")) & (lk >= thr("__sl")))
        | ((dl >= 9.0) & (lk >= 9.0))
        | ((F.col("ptype") != C.VIDEO_PTYPE) & (dl >= 9.0))
    )
    return j.select(*rates.columns, F.coalesce(meets, F.lit(False)).alias("meets_standard"))
