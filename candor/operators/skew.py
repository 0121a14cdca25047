"""Exact per-group row numbers that do not put a whole group in one task.

``Window.partitionBy(g).orderBy(o)`` sends every row of a group to one task. When one
group can hold a large share of all rows (a hot partition/age/gender cell, a hot gid),
``skew_safe_row_number`` gives the same numbers by a different route:

1. a global sort on (group keys, order) -- range partitioning samples the key
   distribution, so a hot group is split over as many partitions as its size needs;
2. every row records its partition and its offset inside it
   (``monotonically_increasing_id`` keeps the partition id in the upper bits);
3. the rows are checkpointed to the shared checkpoint folder, so every later use sees the
   same partitioning even after an executor loss;
4. a small table of pieces -- one row per (partition, group) with its first offset and
   row count -- gets each piece's start inside its group by a running sum over the
   group's pieces (a group spans at most a few partitions);
5. row number = piece start + (offset - first offset) + 1, joined back on (partition, group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def skew_safe_row_number(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    *,
    name: str = "rn",
    num_partitions: int | None = None,
) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)`` with hot groups split.

    ``order`` must be a total order inside a group (add a unique tie-breaker).
    """
    ensure_checkpoint_dir(df.sparkSession)
    sort_cols = [F.col(k).asc_nulls_first() for k in keys] + list(order)
    s = df.repartitionByRange(num_partitions, *sort_cols) if num_partitions else df.repartitionByRange(*sort_cols)
    s = s.sortWithinPartitions(*sort_cols)
    s = s.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__mid"))
    s = s.withColumn("__off", F.col("__mid") - F.shiftleft(F.col("__part").cast("bigint"), 33)).drop("__mid")
    s = s.checkpoint(eager=True)
    pieces = s.groupBy("__part", *keys).agg(F.min("__off").alias("__first"), F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("__start", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    p = pieces.select(F.col("__part").alias("__pp"), *[F.col(k).alias(f"__pk{i}") for i, k in enumerate(keys)],
                      "__first", "__start")
    cond = F.col("__part") == F.col("__pp")
    for i, k in enumerate(keys):
        cond = cond & s[k].eqNullSafe(F.col(f"__pk{i}"))
    j = s.join(p, cond, "inner")
    rn = (F.col("__start") + F.col("__off") - F.col("__first") + 1).cast("bigint")
    drop = ["__part", "__off", "__first", "__start", "__pp"] + [f"__pk{i}" for i in range(len(keys))]
    return j.withColumn(name, rn).drop(*drop)


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    *,
    name: str = "rn",
    salts: int = 32,
) -> DataFrame:
    """The first ``n`` rows of every group (with their number in ``name``), in two levels.

    Rows are dealt to ``salts`` parts of their group by a hash of the whole row; each part keeps
    its first ``n`` (Spark limits them map-side too), and the group's first ``n`` come from at most
    ``salts * n`` rows. A hot group is therefore never numbered whole in one task.
    """
    keys = list(keys)
    part = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts)).cast("int")
    within = Window.partitionBy(*keys, "__salt").orderBy(*order)
    first = df.withColumn("__salt", part).withColumn(name, F.row_number().over(within)).filter(F.col(name) <= n)
    whole = Window.partitionBy(*keys).orderBy(*order)
    ranked = first.drop("__salt", name).withColumn(name, F.row_number().over(whole).cast("bigint"))
    return ranked.filter(F.col(name) <= n)
