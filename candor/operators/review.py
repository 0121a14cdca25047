"""Review board and taxonomy flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .engagement import day_start_epoch


def review_board(
    behaviour: DataFrame,
    posts: DataFrame,
    *,
    since_day: str,
    min_reviews: int = C.REVIEW_MIN_COUNT,
    min_rate: float = C.REVIEW_MIN_RATE,
) -> DataFrame:
    """Per post: review_cnt = SUM(least(create+reply, 2)), expose = COUNT(*), comment_rate.

    Rows need the post's create day and the behaviour day >= ``since_day`` and expose > 0;
    the post-metadata left join is therefore an inner join. Behaviour is summed by post first, so
    a hot post is one row a task before anything is shuffled or joined.
    """
    b = behaviour.filter((F.col("ymd") >= F.lit(since_day)) & (F.col("expose") > 0)).select(
        "pid", F.least(F.col("create_review") + F.col("reply_review"), F.lit(2)).alias("review")
    )
    p = posts.filter(F.col("ct") >= F.lit(day_start_epoch(since_day))).select("pid")
    g = b.groupBy("pid").agg(
        F.sum("review").cast("bigint").alias("review_cnt"),
        F.count(F.lit(1)).cast("bigint").alias("expose"),
    )
    g = g.withColumn("comment_rate", F.col("review_cnt") / F.col("expose"))
    g = g.filter((F.col("review_cnt") >= min_reviews) & (F.col("comment_rate") >= min_rate))
    return g.join(p, "pid", "inner")


def taxonomy_flat(tree: DataFrame, part_tids: DataFrame) -> DataFrame:
    """tid -> (part2_id, part1_id) from the nested partition tree and the partition->topic list.

    Nodes with a negative id or status (status defaults to 100) are dropped, at both
    levels. When a topic (or a part2) shows up more than once the entry with the newest
    ``ct`` wins, ties to the larger id -- a deterministic form of "last one wins".
    """
    p1 = tree.filter(
        (F.col("_id") >= 0) & (F.coalesce(F.col("status"), F.lit(100)) >= 0) & F.col("child_list").isNotNull()
    ).select(F.col("_id").cast("bigint").alias("part1_id"), F.explode("child_list").alias("c"))
    p2 = p1.filter((F.col("c._id") >= 0) & (F.coalesce(F.col("c.status"), F.lit(100)) >= 0)).select(
        "part1_id", F.col("c._id").cast("bigint").alias("part2_id"), F.coalesce(F.col("c.ct"), F.lit(0)).alias("part2_ct")
    )
    order = F.struct("part2_ct", "part1_id")
    parts = p2.groupBy("part2_id").agg(
        F.max_by("part1_id", order).alias("part1_id"), F.max(order).alias("_o")
    ).select("part2_id", "part1_id", F.col("_o.part2_ct").alias("part2_ct"))
    t = part_tids.select(F.col("part2_id").cast("bigint"), F.col("tid").cast("bigint")).join(parts, "part2_id", "inner")
    last = F.struct("part2_ct", "part2_id")
    return t.groupBy("tid").agg(
        F.max_by("part2_id", last).alias("part2_id"), F.max_by("part1_id", last).alias("part1_id")
    )
