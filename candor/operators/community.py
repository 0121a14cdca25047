"""Under-reviewed quality community posts, indexed per partition and post type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.pyfmt import short4
from .index import topn_index, with_heads


def community_review_index(
    docs: DataFrame,
    counters: DataFrame,
    taxonomy: DataFrame,
    *,
    as_of: int,
    days: int = 7,
    tag_col: str = "community_tag",
    tags: tuple[int, ...] = C.COMMUNITY_TAGS,
    max_review: int = C.COMMUNITY_MAX_REVIEW,
    max_rec: int = C.COMMUNITY_MAX_REC,
    ttl: int = C.INDEX_TTL_COMMUNITY,
    default_part2: int = C.DEFAULT_PART2,
    prefix_video: str = "index_part2_community_review_video_",
    prefix_img: str = "index_part2_community_review_img_",
    chunk: int = C.HOT_TOP,
) -> DataFrame:
    """The list of each (partition, type), including partitions with no posts (one piece, value '').

    Lists are kept whole: pieces of ``chunk`` items under ``key#0``, ``key#1``, ... and a head entry
    ``key`` with their number (``operators.index``).

    Posts: ``status = 2``, created in the last ``days``, tagged, with live counters
    ``review < max_review`` and ``rec < max_rec`` (missing counters read as 0). The review
    rate is review/rec at 4 decimals (0 when rec = 0); lists are ordered by it, ties by pid.
    Partitions come from the taxonomy; a post whose partition is not listed is counted but
    not indexed.
    """
    d = docs.filter(
        (F.col("status") == 2) & (F.col("ct") >= F.lit(as_of - days * C.DAY)) & F.col(tag_col).isin(*tags)
    ).select("pid", "ptype", "tid")
    c = counters.select("pid", F.col("rec").alias("c_rec"), F.col("review").alias("c_review"))
    j = d.join(c, "pid", "left").select(
        "pid", "ptype", "tid",
        F.coalesce(F.col("c_rec"), F.lit(0)).alias("rec"),
        F.coalesce(F.col("c_review"), F.lit(0)).alias("review"),
    ).filter((F.col("review") < max_review) & (F.col("rec") < max_rec))
    tax = taxonomy.select("tid", "part2_id")
    j = j.join(tax, "tid", "left").withColumn("part2_id", F.coalesce(F.col("part2_id"), F.lit(default_part2)))
    raw = F.try_divide(F.col("review"), F.col("rec"))
    text = F.when(F.col("rec") > 0, short4(raw)).otherwise(F.lit("0"))
    j = j.select(
        "pid", "part2_id",
        F.when(F.col("ptype") == C.VIDEO_PTYPE, F.lit("video")).otherwise(F.lit("img")).alias("kind"),
        F.when(F.col("rec") > 0, text.cast("double")).otherwise(F.lit(0.0)).alias("review_rate"),
        F.concat(F.col("pid").cast("string"), F.lit(":"), text).alias("item"),
    )
    idx = topn_index(
        j, keys=["kind", "part2_id"], id_col="pid", score_col="review_rate", top=0, text_col="item",
        prefix="", ttl=ttl, as_of=as_of, chunk=chunk,
    ).filter("chunk >= 0").select(F.substring_index("index_key", "#", 1).alias("k"), "chunk", "value", "n_items")
    parts = taxonomy.select("part2_id").distinct().select(
        "part2_id", F.explode(F.array(F.lit("video"), F.lit("img"))).alias("kind")
    )
    parts = parts.select(
        F.when(F.col("kind") == "video", F.lit(prefix_video)).otherwise(F.lit(prefix_img)).alias("prefix"),
        F.concat_ws("_", F.col("kind"), F.col("part2_id").cast("string")).alias("k"),
        "part2_id",
    )
    out = parts.join(idx, "k", "left").select(
        F.concat(F.col("prefix"), F.col("part2_id").cast("string")).alias("index_key"),
        F.coalesce(F.col("chunk"), F.lit(0)).cast("bigint").alias("chunk"),
        F.coalesce(F.col("value"), F.lit("")).alias("value"),
        F.coalesce(F.col("n_items"), F.lit(0)).cast("bigint").alias("n_items"),
    )
    return with_heads(out).withColumn("expires_at", F.lit(as_of + ttl).cast("bigint"))
