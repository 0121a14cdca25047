"""Registered round trips: tables written by a sink to the shared folder and read back by its reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.neighbours import neighbour_lines, valid_posts
from ..operators.pool import pool_clean
from ..operators.review import taxonomy_flat
from ..session import scratch_dir
from ..sinks import writers as W
from ..sinks.retention import expired
from ..sources import fixtures as X
from ..sources import readers as R
from ..sources.tables import table
from .fixture_sql import with_views
from .params import AS_OF
from .q_i2i import _I2I_CTES, _I2I_VIEWS, _SEQ_SQL, _VALID_CTE, neighbours, sequences
from .q_pool import _POOL_SQL, _TAX_SQL, POOL_OVERRIDE_SINCE
from .registry import register

_LINES_SQL = with_views("""
SELECT pid, CAST(rn - 1 AS INTEGER) AS pos, near_pid, score, item
FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY score DESC, sim DESC, near_pid) AS rn FROM neigh) z""",
    *_I2I_VIEWS, extra=_I2I_CTES)


@register("io_neighbour_text", _LINES_SQL, ["score"])
def q_neighbour_text(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "neighbour-text")
    W.write_neighbour_text(neighbour_lines(neighbours(spark, d)), path)
    return R.read_neighbour_text(spark, f"{path}/kind=*")


@register("io_ptype_tid", with_views("SELECT pid, ptype, tid FROM valid", "pool", extra=[_VALID_CTE]))
def q_ptype_tid(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "ptype-tid")
    W.write_ptype_tid(valid_posts(X.pool_docs(spark, d), as_of=AS_OF), path)
    return R.read_ptype_tid_csv(spark, path)


_RANKED_SQL = with_views("SELECT CAST(ptype AS VARCHAR) || '_' || CAST(tid AS VARCHAR) AS key, pid, ctr AS score FROM pool", "pool")


@register("io_ranked_csv", _RANKED_SQL, ["score"])
def q_ranked_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "ranked")
    W.export_csv(X.pool(spark, d).select("tid", "pid", "ctr", "ptype"), path)
    return R.read_ranked_csv(spark, path, key_index_list=[3, 0], pid_index=1, score_index=2)


@register("io_sequence_lines", f"SELECT sentence, count(*) AS n FROM ({_SEQ_SQL}) q GROUP BY sentence")
def q_sequence_lines(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "sequences")
    sequences(spark, d).select(F.array_join("items", " ")).write.text(path)
    back = R.read_sequence_lines(spark, path)
    return back.groupBy(F.array_join("items", " ").alias("sentence")).agg(F.count(F.lit(1)).alias("n"))


@register("io_taxonomy_json", _TAX_SQL)
def q_taxonomy_json(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "taxonomy")
    one = F.lit(1).alias("ret")
    node = F.struct("_id", "name", "ct", "status", "child_list")
    tree = X.taxonomy_raw(spark, d).select(F.to_json(F.struct(one, F.struct(F.array(node).alias("list")).alias("data"))))
    tree.write.option("maxRecordsPerFile", 1).text(f"{path}/tree")
    tids = X.part_tids(spark, d).groupBy("part2_id").agg(F.collect_list("tid").alias("tids"))
    listing = F.array(F.create_map(F.col("part2_id").cast("string"), F.col("tids"))).alias("data")
    tids.select(F.to_json(F.struct(one, listing))).write.option("maxRecordsPerFile", 1).text(f"{path}/tids")
    return taxonomy_flat(R.read_taxonomy_json(spark, f"{path}/tree"), R.read_part_tids_json(spark, f"{path}/tids"))


@register("io_pool_tsv", _POOL_SQL, ["score_mix", "ctr", "play_rate", "dtr", "qscore", "age_tgi"])
def q_pool_tsv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_dir(spark, "pool-tsv")
    clean = pool_clean(X.pool_docs(spark, d), X.step_override(spark, d), as_of=AS_OF, override_since_ct=POOL_OVERRIDE_SINCE)
    W.export_csv(clean, path, sep="\t")
    return spark.read.schema(clean.schema).option("sep", "\t").option("emptyValue", "").option("nullValue", "\\N").csv(path)


# ---------------------------------------------------------------- retention
MODEL_DAYS, HELD = 10, "20240105"  # models are kept for ten days; one version is still being read

_RETENTION_SQL = f"""
SELECT version, n, age_days, age_days > {MODEL_DAYS} AND version <> '{HELD}' AND version <> max(version) OVER () AS expired
FROM (SELECT strftime(CAST(ts AS DATE), '%Y%m%d') AS version, count(*) AS n, date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') AS age_days
      FROM events GROUP BY ALL) v"""


@register("retention_plan", _RETENTION_SQL)
def q_retention_plan(spark: SparkSession, d: str) -> DataFrame:
    """The days of the event table as versions: what the ten-day rule would retire."""
    days = table(spark, d, "events").groupBy(F.date_format("ts", "yyyyMMdd").alias("version")).agg(F.count(F.lit(1)).alias("n"))
    return expired(days, as_of="20240131", max_age_days=MODEL_DAYS, held=days.where(F.col("version") == HELD).select("version"))
