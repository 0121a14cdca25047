"""Sinks: table replace, text exports, versioned publish, index and state snapshots.

Every sink is a distributed DataFrame write; nothing is collected to the driver. Index rows
can also be pushed to an external key-value store per partition (``push_index``), batching
the writes of one task into pipelines.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def replace_table(df: DataFrame, path: str, *, partition_by: Iterable[str] = ()) -> None:
    """Drop-and-create-as-select: overwrite the table's files with the new result."""
    w = df.write.mode("overwrite")
    pb = list(partition_by)
    if pb:
        w = w.partitionBy(*pb)
    w.parquet(path)


def export_csv(df: DataFrame, path: str, *, sep: str = ",", header: bool = False) -> None:
    """CSV / TSV export (the 45-column pool export uses ``sep='\\t'``)."""
    df.write.mode("overwrite").option("sep", sep).option("header", str(header).lower()).csv(path)


MANIFEST = "version string, path string, published_at long"


def publish_version(df: DataFrame, base: str, version: str) -> str:
    """Write ``df`` to a folder of its own under ``base/data`` and then list it in ``base/manifest``.

    A version is never written in place: publishing one again makes a new folder. The manifest row
    is added only after the data's write job has committed, so a reader that goes by the manifest
    (``read_latest``) sees whole versions alone, also while the next one is being written or if
    writing it failed.
    """
    spark, base = df.sparkSession, base.rstrip("/")
    path = f"{base}/data/v={version}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    row = spark.createDataFrame([(version, path, time.time_ns())], MANIFEST)
    row.coalesce(1).write.mode("append").parquet(f"{base}/manifest")
    return path


def published(spark: SparkSession, base: str) -> DataFrame | None:
    """The manifest of ``base`` (version, path, published_at), or None before the first version."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/manifest/_SUCCESS")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(MANIFEST).parquet(f"{base.rstrip('/')}/manifest")


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    """The newest complete version under ``base`` (largest version, then last published) that isn't retired."""
    from .retention import current_versions

    return spark.read.parquet(current_versions(spark, base).orderBy(F.desc("version"), F.desc("published_at")).first()["path"])


def write_index(df: DataFrame, path: str) -> None:
    """Persist index rows (index_key, value, expires_at, ...) as a Parquet snapshot."""
    df.write.mode("overwrite").parquet(path)


def push_index(
    df: DataFrame,
    client_factory: Callable[[], object],
    *,
    batch_size: int = 500,
    as_of: int,
) -> None:
    """Send index rows to a key-value store, one client and batched pipelines per partition.

    ``client_factory`` returns an object with ``pipeline()`` whose result supports
    ``setex(key, seconds, value)`` and ``execute()`` (the common KV-client shape). Keys must be
    unique, or one list would overwrite another: a duplicate raises before anything is sent.
    """
    twice = df.groupBy("index_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"index key {twice[0]['index_key']!r} has {twice[0]['n']} rows")

    def run(rows: Iterable) -> None:
        client = client_factory()
        pipe, n = client.pipeline(), 0
        for r in rows:
            pipe.setex(r["index_key"], max(1, int(r["expires_at"]) - as_of), r["value"])
            n += 1
            if n % batch_size == 0:
                pipe.execute()
                pipe = client.pipeline()
        pipe.execute()

    df.select("index_key", "value", "expires_at").foreachPartition(run)


def upsert(current: DataFrame, updates: DataFrame, key: str | list[str], *, delete_col: str | None = None) -> DataFrame:
    """Next state snapshot = current rows overridden by ``updates`` (full outer join on key).

    Rows of ``updates`` whose ``delete_col`` is true remove the key; keys only in
    ``updates`` are inserted (upsert).
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in current.columns if c not in keys]
    u = updates.select(*keys, *[F.col(c).alias(f"__u_{c}") for c in cols if c in updates.columns],
                       *([F.col(delete_col).alias("__del")] if delete_col else []), F.lit(True).alias("__hit"))
    j = current.join(u, keys, "full_outer")
    out = [F.col(k) for k in keys]
    for c in cols:
        if f"__u_{c}" in u.columns:
            out.append(F.when(F.col("__hit").isNotNull(), F.col(f"__u_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    if delete_col:
        j = j.filter(~F.coalesce(F.col("__del"), F.lit(False)))
    return j.select(*out)


def write_neighbour_text(lines: DataFrame, path: str) -> None:
    """Neighbour lines split by list family: ``path/kind=video``, ``path/kind=img``."""
    lines.select("kind", "line").write.mode("overwrite").partitionBy("kind").text(path)


def write_ptype_tid(valid: DataFrame, path: str) -> None:
    """Valid 'pid,ptype,tid' rows (ptype > 0 and tid > 0)."""
    v = valid.filter((F.col("ptype") > 0) & (F.col("tid") > 0))
    v.select(F.concat_ws(",", "pid", "ptype", "tid").alias("value")).write.mode("overwrite").text(path)


def save_model_snapshot(model, base: str, day: str) -> str:
    """Persist a fitted Spark ML model under ``base/<day>`` (one snapshot per day)."""
    path = f"{base.rstrip('/')}/{day}"
    model.write().overwrite().save(path)
    return path
