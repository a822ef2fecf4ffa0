"""Session settings the jobs are designed for, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    # Timestamps are UTC by policy; NTZ input is read as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot video id, path or source is split at run time, also where the
    # split costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Streaming folds keep one row per item: state belongs on disk.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the recommended settings to a session builder."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; in local mode else a
    temporary one, which goes with the process."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_scratch()


@cache
def _local_scratch() -> str:
    folder = tempfile.mkdtemp(prefix="cliptrack-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
