"""Session helpers.

``build_session`` is for tests, the bench and local runs.  On a cluster the
caller brings its own session; library code only *reads* settings from it.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "basketry", extra: dict | None = None) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("BASKETRY_DRIVER_MEM", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    A cluster names it in ``spark.checkpoint.dir``.  Only a single-process
    session (``local`` / ``local[...]``, as in tests) may fall back to a fresh
    local folder; elsewhere executors would not see each other's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_single_process(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="basketry-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def is_single_process(master: str) -> bool:
    """True for ``local`` and ``local[...]``: driver and tasks share one machine."""
    return master == "local" or master.startswith("local[")
