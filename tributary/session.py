"""Session helpers: a tuned builder and shared work folders.

Work folders (checkpoints, written tables, landed files) always live under
the folder the cluster names in ``spark.checkpoint.dir``.  Only when that
setting is missing *and* the master is local (tests, laptops) do we create a
private one under the system temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is small, split skewed partitions),
# and partition sizes stay bounded.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows carrying whole documents / file bodies: keep Arrow batches small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Loop checkpoints are only needed while a result refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tributary", extra: dict | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """A session for local runs and tests.  In local mode the driver JVM is
    the whole cluster, so give it a real heap (``driver_memory``); on a
    cluster, spark-submit sizes the driver and executors instead."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only when
    the session has none and runs locally."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder")
    path = tempfile.mkdtemp(prefix="tributary-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tributary/{name}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme (for Python code that opens local files)."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


def ensure_local_dir(uri: str) -> str:
    p = local_path(uri)
    if "://" not in p:
        os.makedirs(p, exist_ok=True)
    return uri


def filesystem(uri: str):
    """(pyarrow filesystem, path) for a folder URI -- for the few places
    where Python code in a task reads or writes files itself (one file per
    row, paged-listing stores, the run-log pointer).  Local paths and
    ``file:`` URIs work everywhere; other schemes as pyarrow supports them."""
    import pyarrow.fs as pafs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        uri = "file://" + uri
    if uri.startswith(("s3a://", "s3n://")):  # Hadoop's names for the same store
        uri = "s3://" + uri.split("://", 1)[1]
    return pafs.FileSystem.from_uri(uri)
