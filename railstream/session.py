"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime settings; everything else is left to the deployment.
_SETTINGS = {
    # Local dates and wall clocks are derived from UTC instants.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the operator above would have reused the join's partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Streaming state may outgrow the heap; only changes are written per batch.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, label: str, base: str | None = None) -> str:
    """A fresh path for intermediate tables, under ``base`` or ``spark.checkpoint.dir``.

    Executors must be able to read it back after a loss. So without a named folder the call
    fails, except where driver and executors are one process: then one temporary folder serves
    the whole process and is removed with it. A named folder is cleared by whoever named it.
    """
    base = base or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/railstream/{label}-{uuid.uuid4().hex}"


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="railstream-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
