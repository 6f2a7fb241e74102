"""Session defaults and the shared working folder.

Jobs never pick a machine-local folder on their own: anything that must be
written (published marts, stream checkpoints, lineage cuts) goes below the
folder the cluster names in ``spark.checkpoint.dir``.  Without that setting a
cluster job stops with an error; a local session (tests, the bench), where all
tasks run in one process, gets a temporary one.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on for stable results: UTC wall clock, ANSI
# casts (decimal -> string stays plain, never scientific), AQE for runtime
# re-planning and skew splitting.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "dvspark") -> SparkSession:
    """Local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DVSPARK_DRIVER_MEMORY", "8g"))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # One process, as in tests: its temporary folder is shared with itself.
        configured = tempfile.mkdtemp(prefix="dvspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/dvspark/{name}-{uuid.uuid4().hex[:12]}"


def session_tz(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone", "UTC")
