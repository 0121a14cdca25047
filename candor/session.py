"""SparkSession construction and the few session settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a job needs regardless of cluster size. Shuffle-partition count and
# file split size are left to the cluster profile; AQE coalesces/splits at run time.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def apply_job_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options above on an existing session (e.g. the driver's)."""
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``candor`` importable in the Python workers (pandas UDFs, applyInPandas, state).

    The package source is zipped once per SparkContext and added with ``addPyFile`` -- the
    programmatic form of ``--py-files`` -- so executors can unpickle functions that live in
    the package, whatever the driver's working directory.
    """
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    stage = tempfile.mkdtemp(prefix="candor-pyfiles-", dir="/tmp")
    z = os.path.join(stage, "candor.zip")
    with zipfile.ZipFile(z, "w", zipfile.ZIP_DEFLATED) as f:
        for dirpath, _, files in os.walk(root):
            for fn in files:
                if fn.endswith(".py"):
                    full = os.path.join(dirpath, fn)
                    f.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(z)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; only set one when the cluster named none.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is respected as is; without
    it the job stops, because a machine-local folder would lose rows there. Only a ``local``
    master (tests, the bench) gets a fresh folder under /tmp.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    d = d.rstrip("/") if d else d
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="candor-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/candor/{name}-{uuid.uuid4().hex}"


def set_down(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, for results that several steps read.

    Unlike a cached frame it takes no executor storage, survives lost executors, and its files go
    when nothing refers to it any more (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "candor") -> SparkSession:
    """Session for tests and the local bench (``local[N]``)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CANDOR_DRIVER_MEMORY", "16g"))
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32m")
        # checkpoint files of the skew-safe numbering are removed once no plan references them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def cluster_profile(input_bytes: float, *, executors: int, cores_per_executor: int,
                    target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Size-dependent settings for a cluster run (pass them to spark-submit / the builder).

    Shuffle partitions are sized so each holds about ``target_partition_bytes`` of the
    largest shuffle (taken as the input size, an upper bound for these jobs) and at least a
    few waves of the cluster's cores; AQE then coalesces small ones and splits skewed ones.
    """
    cores = max(1, executors * cores_per_executor)
    parts = max(3 * cores, int(input_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(32 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **JOB_CONF,
    }
