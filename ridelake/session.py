"""SparkSession construction and session-level settings.

Batch library functions never depend on the session time zone: timestamps
are TIMESTAMP_NTZ and all arithmetic on them uses NTZ-safe built-ins
(``timestampdiff``, interval addition, comparisons).  The one exception is
streaming, where ``withWatermark`` needs a TIMESTAMP event time (cast in the
session zone; UTC is the default set here).  The settings below only tune
execution.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Execution defaults.  AQE coalesces the post-shuffle partitions to the data
# size and splits skewed join partitions at runtime; the shuffle partition
# count is an upper bound that AQE shrinks on small inputs.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Cluster sizing (100 TB class inputs).  Shuffle partitions start from the
# input volume at ~128 MB per partition and AQE coalesces them down; scans
# split at 256 MB; a partition over 256 MB and 5x the median is treated as
# skewed and split by AQE's skew join.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}


def cluster_shuffle_partitions(input_bytes: int, min_partitions: int = 200) -> int:
    """Initial shuffle partition count for an input of ``input_bytes``: one
    partition per 128 MB of input (AQE coalesces small ones and splits skewed
    ones)."""
    return max(min_partitions, -(-int(input_bytes) // TARGET_PARTITION_BYTES))


def build_session(master: str | None = None, app_name: str = "ridelake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  cluster_input_bytes: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's execution defaults.

    ``cluster_input_bytes``: size of the inputs a cluster job will read; adds
    ``CLUSTER_CONF`` and sizes the initial shuffle partitions from it."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster_input_bytes:
        conf.update(CLUSTER_CONF)
        conf["spark.sql.shuffle.partitions"] = str(cluster_shuffle_partitions(cluster_input_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` (or a directory already set on the context) wins.
    Only a local session without either gets a scratch folder of its own; on a
    cluster a folder that executors do not share would lose data, so that
    raises instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ridelake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), name)
