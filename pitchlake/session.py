"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# AQE re-plans joins and partition counts from the sizes it measures at run time,
# so shuffle.partitions is only an upper bound that it coalesces from.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A dimension's keys up to this estimate go to every executor instead of shuffling the fact.
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    # The JVM never compiles methods above 8000 bytes of bytecode; beyond that size operators are
    # faster one by one than fused into a method that stays interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Stream state beyond the heap goes to local disk and to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(app_name: str = "pitchlake", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session. ``master`` stays unset under spark-submit; conf keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` as the cluster sets it.

    Only a local session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="pitchlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever written to the same path twice."""
    return f"{shared_dir(spark)}/pitchlake/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside it, the files that a query shuffled go when it ends.

    Otherwise they stay until the driver collects its garbage, which may be never in a job whose
    rows don't pass the driver. A frame that is executed again shuffles again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable without changing a folder that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
