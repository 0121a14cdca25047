"""Recall quality reports: exposure share and CTR by source, audience segment and partition.

All three are single group-bys with map-side partial aggregation. The totals they divide
by are window sums over the *aggregated* rows (one row per source / segment / partition,
so tiny), never a join against a total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C


def recall_source_quality(log: DataFrame) -> DataFrame:
    """(mid, pid, source, exposed, clicked) -> (source, exposed, clicked, exposure_share, ctr)."""
    g = log.groupBy("source").agg(
        F.sum("exposed").cast("bigint").alias("exposed"), F.sum("clicked").cast("bigint").alias("clicked")
    )
    tot = F.sum("exposed").over(Window.partitionBy())          # over one row per source
    return g.select(
        "source", "exposed", "clicked",
        F.try_divide(F.col("exposed"), tot).alias("exposure_share"),
        F.try_divide(F.col("clicked"), F.col("exposed")).alias("ctr"),
    )


def recall_segment_quality(log: DataFrame, users: DataFrame) -> DataFrame:
    """Per (source, gender, age): exposure share within the segment and CTR.

    Users without metadata fall in gender 0 / age 0, as in the hot ranking.
    """
    u = users.select("mid", "gender", "age")
    j = log.join(u, "mid", "left").select(
        "source", "exposed", "clicked",
        F.coalesce(F.col("gender"), F.lit(C.DEFAULT_GENDER)).cast("bigint").alias("gender"),
        F.coalesce(F.col("age"), F.lit(C.DEFAULT_AGE)).cast("bigint").alias("age"),
    )
    g = j.groupBy("source", "gender", "age").agg(
        F.sum("exposed").cast("bigint").alias("exposed"), F.sum("clicked").cast("bigint").alias("clicked")
    )
    seg = F.sum("exposed").over(Window.partitionBy("gender", "age"))
    return g.select(
        "source", "gender", "age", "exposed", "clicked",
        F.try_divide(F.col("exposed"), seg).alias("exposure_share"),
        F.try_divide(F.col("clicked"), F.col("exposed")).alias("ctr"),
    )


def recall_partition_share(
    log: DataFrame, posts: DataFrame, taxonomy: DataFrame, *, default_part2: int = C.DEFAULT_PART2
) -> DataFrame:
    """Share of recalled posts per first- and second-level partition (ROLLUP part1, part2).

    Rows with ``part2_id`` NULL are part1 subtotals; the row with both NULL is the total.
    Posts whose topic has no partition count under part2 72 / part1 0.
    """
    p = posts.select("pid", "tid")
    t = taxonomy.select("tid", "part1_id", "part2_id")
    by_pid = log.groupBy("pid").agg(F.sum("exposed").alias("exposed"))  # a hot post is one row a task
    j = by_pid.join(p, "pid", "left").join(t, "tid", "left").select(
        "exposed",
        F.coalesce(F.col("part1_id"), F.lit(0)).cast("bigint").alias("part1_id"),
        F.coalesce(F.col("part2_id"), F.lit(default_part2)).cast("bigint").alias("part2_id"),
    )
    g = j.rollup("part1_id", "part2_id").agg(F.sum("exposed").cast("bigint").alias("exposed"))
    # the rollup's own grand-total row (both keys NULL) is the denominator
    tot = F.max(F.when(F.col("part1_id").isNull() & F.col("part2_id").isNull(), F.col("exposed"))).over(Window.partitionBy())
    return g.select("part1_id", "part2_id", "exposed", F.try_divide(F.col("exposed"), tot).alias("post_share"))


def recall_volume(log: DataFrame) -> DataFrame:
    """Per day and source: served candidates, distinct users and posts, candidates per user."""
    g = log.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "source").agg(
        F.sum("exposed").cast("bigint").alias("served"), F.countDistinct("mid").alias("users"),
        F.countDistinct("pid").alias("posts"))
    return g.withColumn("per_user", F.try_divide(F.col("served"), F.col("users")))


def recall_freshness(log: DataFrame, posts: DataFrame, *, as_of: int, bounds: tuple[int, ...] = (1, 3, 7, 30)) -> DataFrame:
    """Per source and age band of the served posts (days since creation at ``as_of``): exposures, share
    within the source. The band is the smallest bound above the age, -1 beyond all, null if the
    post is unknown. The log is summed by post before the join."""
    age = (F.lit(as_of) - F.col("ct")) / C.DAY
    band = F.lit(-1)
    for x in reversed(bounds):
        band = F.when(age < x, F.lit(x)).otherwise(band)
    by_pid = log.groupBy("pid", "source").agg(F.sum("exposed").alias("exposed"))
    j = by_pid.join(posts.select("pid", "ct"), "pid", "left")
    g = j.groupBy("source", F.when(F.col("ct").isNotNull(), band).cast("bigint").alias("max_days")).agg(
        F.sum("exposed").cast("bigint").alias("exposed"))
    return g.withColumn("share", F.try_divide(F.col("exposed"), F.sum("exposed").over(Window.partitionBy("source"))))
