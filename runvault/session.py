"""Session helpers.

Library code never creates its own session; it takes the caller's.  These
helpers exist for tests, the bench and the driver entry point.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only from sizes measured at run time (AQE), never from
    # file-size estimates: an aggregated or exploded side can be far larger
    # than its source files suggest.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "8MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches to Python workers carry whole texts and chunks: cap bytes,
    # not only records.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used by library code)."""
    builder = (SparkSession.builder.master(f"local[{cores}]")
               .appName("runvault")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is only read; without
    it the call fails, since a folder of one machine is of no use there.  Only
    a single-process local session gets a scratch folder when it is unset.
    """
    context = spark.sparkContext
    if current := context.getCheckpointDir():
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="runvault-ckpt-")
    context.setCheckpointDir(conf)
    return context.getCheckpointDir() or conf


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder (shared storage on a cluster)."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
