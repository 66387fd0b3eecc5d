"""Session helpers.

Library code never creates a session; callers (tests, bench, jobs) do.
The settings below are the ones the pipelines are designed around:
adaptive execution (runtime coalescing, skew-join splitting, broadcast
conversion from measured sizes) and a UTC session zone so calendar
arithmetic on TIMESTAMP_NTZ data is zone-independent.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed join partitions even when that costs an extra shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def get_session(master: str | None = None, app: str = "fieldlens",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local"):
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the cluster's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is
    used as is.  Only in local mode, when it is unset (tests), a scratch
    folder is set; on a cluster an unset directory is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = fallback or tempfile.mkdtemp(prefix="fieldlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new folder name under the checkpoint directory, which all executors
    share; what is written there goes when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path
