"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings only: partition counts, memory and broadcast limits belong to whoever owns the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # First-n-per-key queries cut every key to n rows in each task before the shuffle, whatever n is.
    "spark.sql.optimizer.windowGroupLimitThreshold": str(2**31 - 1),
    # Sessions of a busy key are merged where they are read, before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

_test_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the time zone, calendar rebasing and adaptive execution for this session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``.

    Tables written there survive the loss of executors. Only a local-mode session may go without the
    setting; it gets one temporary folder per application.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = _test_roots.get(context.applicationId)
        if root is None:
            root = _test_roots[context.applicationId] = tempfile.mkdtemp(prefix="forgemart-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
