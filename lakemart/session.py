"""Spark session setup shared by tests, bench and the query registry."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings every lakemart job relies on. They are session-level
# (not static) so they can be applied to a session someone else created.
RUNTIME_CONF = {
    # Results must not depend on the host time zone: event times are
    # wall-clock values and the oracle engine treats them as UTC.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution: runtime broadcast of small join sides (size checked
    # by Spark against the threshold below), partition coalescing and
    # splitting of skewed sort-merge-join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Streaming state in RocksDB (off-heap, incremental checkpoints) rather
    # than in the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_spark(master: str | None = None, app: str = "lakemart",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session. ``master`` defaults to ``local[*]``;
    on a cluster pass nothing and let spark-submit decide."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    elif not os.environ.get("SPARK_MASTER") and not os.environ.get("PYSPARK_SUBMIT_ARGS"):
        builder = builder.master("local[*]")
    builder = builder.config("spark.ui.enabled", "false")
    # remove checkpoint files (dense-key steps) once their data is unreferenced
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if (master or "local").startswith("local"):
        # local mode: the driver JVM is the only executor
        builder = builder.config("spark.driver.memory", os.environ.get("LAKEMART_DRIVER_MEMORY", "12g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (shared storage); only a
    local-mode session without one (tests) gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", sc.master):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared "
                           "folder for this cluster")
    path = tempfile.mkdtemp(prefix="lakemart-ckpt-")
    sc.setCheckpointDir(path)
    return path
