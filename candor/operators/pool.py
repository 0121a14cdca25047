"""Candidate-pool cleaning into the 45-column warehouse layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C

# FIXED VALUES: output column order of the pool table
POOL_COLUMNS = (
    "pid", "mid", "tid", "ptype", "gid", "ct", "rec", "download_num", "like_num", "score_mix", "gid_ct", "fans",
    "atts", "is_vulgar", "is_sexy", "choice_status", "choice_types", "vdur", "real_sume", "ctr", "play_rate", "dtr",
    "qscore", "age_tgi", "mover_level", "mover_part_id", "review_cnt", "community_tag_new", "community_tag_high",
    "community_pre_tag", "share_num", "step_boot", "step_boot_t", "community_tag_godrev", "subarea_status",
    "subarea_types", "like_bait", "resource_status", "subarea_time", "detail_cnt", "source", "original",
    "assist_status", "official_template_id", "community_hashtag_post",
)


def _z(c: str, dtype: str = "bigint") -> Column:
    return F.coalesce(F.col(c).cast(dtype), F.lit(0).cast(dtype))


def pool_clean(
    docs: DataFrame,
    step_override: DataFrame,
    *,
    as_of: int,
    tag_col: str = "community_tag_new",
    old_age: int = C.POOL_OLD_AGE,
    very_old_age: int = C.POOL_VERY_OLD_AGE,
    min_rec: int = C.POOL_MIN_REC,
    min_choice_status: int = C.POOL_MIN_CHOICE_STATUS,
    min_rate: float = C.POOL_MIN_RATE,
    override_since_ct: int = C.POOL_OVERRIDE_SINCE_CT,
) -> DataFrame:
    """Drop invalid / stale posts and flatten the documents into ``POOL_COLUMNS``.

    Drops: pid<=0, gid<=0, ptype<=1, status<2; older than 30 d with rec<1000; older than
    120 d outside the choice pool; older than 30 d with both download and like per
    (rec+10) below 0.003 (ages strictly greater). Posts still at step 0 created after the
    override epoch take step state from the override table (left join on pid).
    """
    sv = lambda f: F.coalesce(F.col(f"score_values.{f}"), F.lit(0))
    age = F.lit(as_of) - _z("ct")
    rec = sv("rec")
    d = docs.filter(
        (_z("pid") > 0) & (_z("gid") > 0) & (_z("ptype") > 1) & (_z("status") >= 2)
        & ~((age > old_age) & (rec < min_rec))
        & ~((age > very_old_age) & (_z("choice_status") < min_choice_status))
        & ~((age > old_age) & (sv("download") / (rec + C.POOL_RATE_SMOOTHING) < min_rate)
            & (sv("like") / (rec + C.POOL_RATE_SMOOTHING) < min_rate))
    )
    o = step_override.select(
        "pid", F.col("step_boot").alias("o_step_boot"), F.col("step_boot_t").alias("o_step_boot_t"),
        F.lit(True).alias("o_hit"),
    )
    d = d.join(o, "pid", "left")
    use_o = (_z("step_boot") == 0) & (_z("ct") >= override_since_ct) & F.col("o_hit").isNotNull()
    author_ok = F.col("author").isNotNull()
    tags = F.coalesce(F.col("censor_tags"), F.array().cast("array<bigint>"))
    out = {
        "pid": _z("pid"), "mid": _z("mid"), "tid": _z("tid"), "ptype": _z("ptype"), "gid": _z("gid"),
        "ct": _z("ct"), "rec": rec.cast("bigint"), "download_num": sv("download").cast("bigint"),
        "like_num": sv("like").cast("bigint"), "score_mix": _z("score_mix", "double"), "gid_ct": _z("gid_ct"),
        "fans": F.coalesce(F.col("author.fans"), F.lit(0)).cast("bigint"),
        "atts": F.coalesce(F.col("author.atts"), F.lit(0)).cast("bigint"),
        "is_vulgar": F.array_contains(tags, C.CENSOR_TAG_VULGAR).cast("bigint"),
        "is_sexy": F.array_contains(tags, C.CENSOR_TAG_SEXY).cast("bigint"),
        "choice_status": _z("choice_status"),
        "choice_types": F.array_join(F.coalesce(F.col("choice_types"), F.array().cast("array<bigint>")), ","),
        "vdur": _z("vdur"), "real_sume": sv("real_sume").cast("bigint"), "ctr": sv("ctr").cast("double"),
        "play_rate": sv("play_rate").cast("double"), "dtr": sv("dtr").cast("double"),
        "qscore": sv("qscore").cast("double"), "age_tgi": _z("age_tgi", "double"),
        "mover_level": F.when(author_ok, F.coalesce(F.col("author.mover_level"), F.lit(0))).otherwise(0).cast("bigint"),
        "mover_part_id": F.when(author_ok, F.coalesce(F.col("author.mover_part_id"), F.lit(0))).otherwise(0).cast("bigint"),
        "review_cnt": sv("review").cast("bigint"), "community_tag_new": _z(tag_col),
        "community_tag_high": _z("community_tag_high"), "community_pre_tag": _z("community_pre_tag"),
        "share_num": sv("share").cast("bigint"),
        "step_boot": F.when(use_o, F.coalesce(F.col("o_step_boot"), F.lit(0))).otherwise(_z("step_boot")).cast("bigint"),
        "step_boot_t": F.when(use_o, F.coalesce(F.col("o_step_boot_t"), F.lit(0))).otherwise(_z("step_boot_t")).cast("bigint"),
        "community_tag_godrev": _z("community_tag_godrev"), "subarea_status": _z("subarea_status"),
        "subarea_types": F.array_join(F.coalesce(F.col("subarea_types"), F.array().cast("array<bigint>")), ","),
        "like_bait": _z("like_bait"), "resource_status": _z("resource_status"), "subarea_time": _z("subarea_time"),
        "detail_cnt": sv("detail").cast("bigint"), "source": F.coalesce(F.col("source"), F.lit("")),
        "original": _z("original"), "assist_status": _z("assist_status"),
        "official_template_id": _z("official_template_id"), "community_hashtag_post": _z("community_hashtag_post"),
    }
    return d.select(*[out[c].alias(c) for c in POOL_COLUMNS])
