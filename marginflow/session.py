"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this engine wants; a cluster launcher may override them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the join feeds an aggregate on the same key
    # (costs one extra shuffle instead of one straggler task holding a hot customer).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python call-site capture for error messages costs several JVM round trips per
    # Column call while plans are built; the engine's plans are built from library code.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def scale_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Shuffle and scan sizing for a given input volume and cluster size.

    About 256 MB per post-shuffle partition (fits an executor task's memory share without
    spilling on the order-level shuffles), at least two tasks per core; scans split at the
    same size.  AQE coalesces partitions that turn out small and splits skewed ones.
    Example: 100 TB on 1000 executors x 8 cores -> 409,600 shuffle partitions.
    """
    partitions = max(2 * total_cores, -(-input_bytes // TARGET_PARTITION_BYTES))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "marginflow", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults.

    ``shuffle_partitions`` should be sized so one post-shuffle partition holds roughly
    128-256 MB at the target scale; AQE coalesces small ones at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and checkpoints.

    Uses the cluster's ``spark.checkpoint.dir`` when set.  Where it is unset, a local master
    (tests) gets a fresh folder of its own, registered as the checkpoint directory; any other
    master is refused, as its executors would each write to a disk of their own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder shared by all executors (master {master})")
    base = tempfile.mkdtemp(prefix="marginflow-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(base)
    return spark.sparkContext.getCheckpointDir() or base
