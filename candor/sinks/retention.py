"""Retention of published versions and dated inputs: what has aged out is listed, retired, and only later removed.

``expired`` lists; nothing is deleted by it. ``retire`` marks expired versions in ``base/retired``, which readers that go by the manifest
(``current_versions``) no longer choose. ``sweep`` removes the folders of versions that were retired at least
``grace`` seconds ago, so a reader that chose one before keeps its files while it runs. The newest version and those that a reader
holds (``held``) are never retired, whatever their age.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .writers import published

RETIRED = "path string, retired_at long"


def _day(version: Column) -> Column:
    """The day that a version's name begins with ('yyyyMMdd...'), else null."""
    return F.when(version.rlike("^[0-9]{8}"), F.try_to_timestamp(F.substring(version, 1, 8), F.lit("yyyyMMdd")).cast("date"))


def expired(versions: DataFrame, *, as_of: str, max_age_days: int, held: DataFrame | None = None) -> DataFrame:
    """``versions`` (version, ...) with age_days and ``expired``: older than ``max_age_days`` at day ``as_of`` ('yyyyMMdd'), not the newest, not ``held`` (version).

    Names that don't begin with a day have no age and stay.
    """
    age = F.datediff(F.to_date(F.lit(as_of), "yyyyMMdd"), _day(F.col("version")))
    newest = versions.agg(F.max("version").alias("newest"))  # one row
    h = (held if held is not None else versions.limit(0)).select(F.col("version").alias("h_version")).distinct()
    v = versions.withColumn("age_days", age.cast("bigint")).join(h, F.col("version") == F.col("h_version"), "left")
    v = v.join(newest, F.col("version") == F.col("newest"), "left")
    old = F.coalesce(F.col("age_days") > max_age_days, F.lit(False)) & F.col("h_version").isNull() & F.col("newest").isNull()
    return v.withColumn("expired", old).drop("h_version", "newest")


def retired(spark: SparkSession, base: str) -> DataFrame:
    """(path, retired_at) of versions marked so far."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/retired")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], RETIRED)
    return spark.read.schema(RETIRED).parquet(str(path.toString()))


def current_versions(spark: SparkSession, base: str) -> DataFrame:
    """The manifest (version, path, published_at) without retired versions."""
    manifest = published(spark, base)
    if manifest is None:
        raise FileNotFoundError(f"no version is published under {base}")
    return manifest.join(retired(spark, base).select("path").distinct(), "path", "left_anti").select("version", "path", "published_at")


def retire(spark: SparkSession, base: str, *, as_of: str, max_age_days: int, held: DataFrame | None = None, now: int | None = None) -> int:
    """Mark what has expired; returns the number of versions marked."""
    old = expired(current_versions(spark, base), as_of=as_of, max_age_days=max_age_days, held=held).where("expired")
    rows = [(r["path"], now if now is not None else int(time.time())) for r in old.select("path").collect()]  # a row a version
    if rows:
        spark.createDataFrame(rows, RETIRED).coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/retired")
    return len(rows)


def sweep(spark: SparkSession, base: str, *, grace: int = 86400, now: int | None = None) -> list[str]:
    """Remove the folders of versions retired ``grace`` seconds ago or earlier; returns those removed now."""
    now = now if now is not None else int(time.time())
    gone = []
    for r in retired(spark, base).groupBy("path").agg(F.min("retired_at").alias("at")).where(F.col("at") <= now - grace).orderBy("path").collect():
        path = spark._jvm.org.apache.hadoop.fs.Path(r["path"])
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(path) and files.delete(path, True):
            gone.append(r["path"])
    return gone
