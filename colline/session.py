"""Local sessions for tests and the bench.  Library code never builds a session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from colline.sources.storage import CHECKPOINT_CONF


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "colline") -> SparkSession:
    """A ``local[cores]`` session tuned for small inputs.

    ``COLLINE_CHECKPOINT_DIR`` names a checkpoint folder; without it the site's
    setting, if any, stays as it is.  The web UI stays off.
    ``COLLINE_EVENT_LOG_DIR`` writes Spark's event log there (a scratch folder).
    ``COLLINE_OFFHEAP`` (e.g. ``8g``) moves Tungsten memory off the JVM heap;
    off by default (no clear gain measured on a noisy host).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("COLLINE_DRIVER_MEMORY", "16g"))
    )
    ckpt = os.environ.get("COLLINE_CHECKPOINT_DIR")
    if ckpt:
        builder = builder.config(CHECKPOINT_CONF, ckpt)
    event_dir = os.environ.get("COLLINE_EVENT_LOG_DIR")
    if event_dir:
        # stage and task times for scripts/stage_times.py (the UI stays off)
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    offheap = os.environ.get("COLLINE_OFFHEAP")
    if offheap:
        # Tungsten pages (hash maps, sort buffers) outside the JVM heap: no GC
        # pauses over large aggregation maps
        builder = builder.config("spark.memory.offHeap.enabled", "true").config("spark.memory.offHeap.size", offheap)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
