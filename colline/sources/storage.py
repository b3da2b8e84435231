"""Shared-storage helpers: the checkpoint folder and materialised intermediates.

A materialised table lives under the folder the session names in
``spark.checkpoint.dir`` (the cluster's shared, fault-tolerant storage).  When
that setting is absent, :func:`materialize` writes nothing and plans stay lazy,
while :func:`materialize_always` falls back to a fresh temporary folder on a
``local`` master (one machine) and refuses to run on a cluster.

Tables written here are remembered per session; :func:`release` deletes them
once their results have been consumed.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Paths written by this process, and the folder of a local session without one, by Spark application id.
_WRITTEN: dict[str, list[str]] = {}
_OWN: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The session's ``spark.checkpoint.dir``, or None when it is unset."""
    value = spark.conf.get(CHECKPOINT_CONF, None)
    if not value:
        value = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    return value or None


def shared_dir(spark: SparkSession) -> str:
    """:func:`checkpoint_dir`, or a temporary folder set for a local session without one."""
    base = checkpoint_dir(spark)
    if base is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        app = spark.sparkContext.applicationId
        base = _OWN.setdefault(app, "") or tempfile.mkdtemp(prefix="colline-shared-")
        _OWN[app] = base
    return base


def new_path(spark: SparkSession, name: str, base: str | None = None) -> str:
    """A fresh path in the shared folder, remembered for :func:`release`."""
    path = f"{(base or shared_dir(spark)).rstrip('/')}/colline-{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _write(df: DataFrame, base: str, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    spark = df.sparkSession
    path = new_path(spark, name, base)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    This cuts the lineage (a lost executor re-reads the table instead of
    re-running the scan and shuffle that produced it) and lets several jobs
    share one computation.  Without a checkpoint folder ``df`` is returned
    unchanged.
    """
    base = checkpoint_dir(df.sparkSession)
    return df if base is None else _write(df, base, name)


def materialize_always(df: DataFrame, name: str) -> DataFrame:
    """:func:`materialize`, for operators that need the table written (see :func:`shared_dir`)."""
    return _write(df, shared_dir(df.sparkSession), name)


def written(spark: SparkSession) -> int:
    """How many tables this session's operators have materialised and not released; a mark for :func:`release`."""
    return len(_WRITTEN.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, since: int = 0, keep: Collection[str] = ()) -> int:
    """Delete the tables this session's operators have materialised; returns how many.

    Call it after the results that read them have been written or collected.
    ``since`` (a mark of :func:`written`) leaves older tables alone, ``keep``
    the tables at these paths.
    """
    paths = _WRITTEN.get(spark.sparkContext.applicationId, [])
    gone = [p for p in paths[since:] if p not in keep]
    paths[since:] = [p for p in paths[since:] if p in keep]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in gone:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(gone)
