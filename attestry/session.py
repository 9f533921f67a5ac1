"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the plans rely on. Shuffle partition counts are left to
# the cluster; AQE coalesces small partitions and splits skewed ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when a later aggregate then needs its own
    # shuffle: that shuffle carries partial aggregates only.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # File sizes say little about derived text columns, so only really small files
    # are broadcast by estimate; anything else is broadcast when its size, measured
    # after its shuffle, is below the second limit.
    "spark.sql.autoBroadcastJoinThreshold": "1MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # AQE turns a sort-merge join into a hash join when every partition is
    # small enough at run time; the size is checked, not assumed.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names storage every executor can reach, so tables
    and stream checkpoints written there survive the loss of an executor. Where
    it is unset, a local session gets a temporary folder; on a cluster, whose
    executors would not see that, it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="attestry-")
    return f"{base.rstrip('/')}/attestry-{purpose}-{uuid.uuid4().hex}"


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any store that Spark reads; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in store.listStatus(folder)] if store.exists(folder) else []
