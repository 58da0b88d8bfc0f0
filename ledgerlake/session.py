"""Session helpers.

Libraries never create sessions; ``build_session`` exists for tests, the bench and
command-line jobs.  ``scratch_dir`` hands out unique directories below the shared
folder the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job relies on.  AQE re-plans joins at runtime: it turns a join side into
# a broadcast only after measuring it (adaptive.autoBroadcastJoinThreshold), splits
# skewed shuffle partitions of sort-merge joins, and coalesces small partitions.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerlake", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def use_utc(spark: SparkSession) -> None:
    """The only session-wide setting queries touch: timestamps are read in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where none is named.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage (HDFS, S3, ...);
    a machine-local fallback is only acceptable for a local master, as in tests.
    Works for classic sessions and, through the session conf, for Spark Connect.
    """
    try:
        sc = spark.sparkContext
    except Exception:                      # Spark Connect: no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    if sc is None:
        spark.conf.set("spark.checkpoint.dir", conf_dir)
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_SCRATCH: list[str] = []


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    _SCRATCH.append(f"{base.rstrip('/')}/ledgerlake/{purpose}-{uuid.uuid4().hex}")
    return _SCRATCH[-1]


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch folders made inside the block when it ends.  DataFrames that
    read them cannot be used afterwards: write their results within the block."""
    from ledgerlake.sources.tables import delete_path
    kept = len(_SCRATCH)
    try:
        yield
    finally:
        while len(_SCRATCH) > kept:
            delete_path(spark, _SCRATCH.pop())


#: Where Spark knows it (4.1), the shuffle files of an execution go when it ends, not when the driver
#: happens to collect its garbage.  An execution is not run twice here; Spark would repeat the stages.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_released(spark: SparkSession):
    """What is executed inside the block gives its shuffle files back at its end."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)


@contextlib.contextmanager
def step_scope(spark: SparkSession):
    """``scratch_scope`` and ``shuffles_released``: a step leaves on disk what it returns."""
    with scratch_scope(spark), shuffles_released(spark):
        yield


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so local test code can list a folder."""
    return path[len("file:"):] if path.startswith("file:") else path


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def object_store_conf(endpoint: str | None = None, path_style: bool = True,
                      timeout_ms: int = 60000) -> dict[str, str]:
    """S3A settings for an S3-compatible store, to pass to the session builder
    or spark-submit.  Credentials are deliberately absent: supply them through the
    cluster's credential provider chain, never in code."""
    conf = {"spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
            "spark.hadoop.fs.s3a.connection.timeout": str(timeout_ms),
            "spark.hadoop.fs.s3a.connection.establish.timeout": str(timeout_ms)}
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    return conf


def scale_conf(shuffle_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle and scan sizing for a run that shuffles about ``shuffle_bytes``.

    Shuffle partitions are sized so each holds about ``target_partition_bytes``
    (a size a task can sort in executor memory, spilling if needed), and never fewer
    than two waves of the cluster's cores; AQE then coalesces toward the advisory size
    and splits skewed partitions.  Scan splits stay at 128 MB.  For 100 TB shuffled on
    1000 executors x 8 cores this gives ~410,000 partitions of ~256 MB.
    """
    partitions = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    }
