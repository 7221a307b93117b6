"""Session helpers: one place for the Spark settings the engine relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the semantics depend on (UTC timestamps, ANSI on, AQE with skew
# handling).  Sizing knobs (shuffle partitions, max partition bytes) are left
# to the cluster; tests and the bench override them for local[n].
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming state on disk, not in the heap
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app_name: str = "txguard",
              conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Return a path inside the cluster's shared checkpoint folder.

    The folder is taken from ``spark.checkpoint.dir`` (or the context's
    checkpoint dir).  Only a local-mode session without that setting gets a
    fresh scratch folder of its own; a cluster session without it is an error,
    because a machine-local folder would not survive executor loss.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; txguard needs a shared folder "
                "for checkpoints and written intermediate tables")
        base = tempfile.mkdtemp(prefix="txguard-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, *parts) if parts else base


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return shared_dir(spark)


def fresh_shared_path(spark: SparkSession, prefix: str) -> str:
    """A new, unique path under the shared folder (never reused)."""
    return shared_dir(spark, "txguard", f"{prefix}-{uuid.uuid4().hex}")
