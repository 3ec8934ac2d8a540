"""Session construction and the shared folder every job writes scratch data to."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC clock, ANSI casts (Spark default), AQE with
# skew-join splitting, and duplicate JSON keys accepted as Python's json does.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
    # delete checkpoint files once their DataFrame is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "matchlake",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    ``master`` and ``shuffle_partitions`` are only set when given, so that a
    cluster submit keeps the values of its own configuration.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Folder on the storage all executors share, under ``spark.checkpoint.dir``.

    The cluster names that folder; we only pick one ourselves when it is unset
    and the session runs in local mode (tests, laptops).  A machine-local
    temporary folder is never used on a cluster.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises on some versions
            root = None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="matchlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return os.path.join(root, *parts) if parts else root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named folder under the shared folder."""
    import uuid

    return shared_dir(spark, "matchlake", f"{name}-{uuid.uuid4().hex[:12]}")
