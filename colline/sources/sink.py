"""A sink that can be run again: one copy of every batch, and a manifest of what it holds.

A batch is one partition of a parquet folder.  Spark stages its files and moves
them into place when the job commits, replacing that partition only (dynamic
partition overwrite), so a failed or interrupted write leaves what was there
and a second run leaves one copy.  After that the batch's rows, points and an
order-free fingerprint are read back and written to the manifest in the same
way; :func:`read_batches` returns only batches whose files still say the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

BATCH = "batch"


def _manifest_path(path: str) -> str:
    return path.rstrip("/") + "_manifest"


def _overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)


def _figures(df: DataFrame) -> DataFrame:
    """``batch, rows, points, fingerprint`` (a sum and an xor over rows say the same in any order)."""
    own = [c for c in df.columns if c != BATCH]
    points = F.sum(F.size("points")).cast("bigint") if "points" in own else F.lit(None).cast("bigint")
    return df.groupBy(BATCH).agg(
        F.count(F.lit(1)).alias("rows"), points.alias("points"), F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in own])).alias("fingerprint")
    )


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).withColumn(BATCH, F.col(BATCH).cast("string"))


def write_batch(sets: DataFrame, path: str, batch: str) -> None:
    """Write ``sets`` as the batch of this name, in place of an earlier one of the name.

    The name is a partition value: no empty string.  An empty result removes
    nothing and leaves no files, so its manifest row counts 0 and an earlier
    batch of the name is no longer listed.
    """
    if not batch or BATCH in sets.columns:
        raise ValueError("a batch needs a name, and the result must not have a column of that name")
    spark, written = sets.sparkSession, Observation()
    _overwrite(sets.withColumn(BATCH, F.lit(batch)).observe(written, F.count(F.lit(1)).alias("rows")), path)
    if not written.get["rows"]:
        figures = spark.range(1).select(
            F.lit(batch).alias(BATCH), F.lit(0).cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("points"), F.lit(0).cast("bigint").alias("fingerprint")
        )
    else:
        figures = _figures(_read(spark, path).where(F.col(BATCH) == batch))
    _overwrite(figures, _manifest_path(path))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``batch, rows, points, fingerprint`` of every batch written."""
    return _read(spark, _manifest_path(path)).select(BATCH, "rows", "points", "fingerprint")


def read_batches(spark: SparkSession, path: str, *batches: str) -> DataFrame:
    """The rows of the named batches (all without names), with their ``batch``.

    Files without a manifest row (a write that ended between its two steps) are
    left out; a batch whose files differ from its manifest row raises.
    """
    listed = {r[BATCH]: r for r in read_manifest(spark, path).where("rows > 0").collect()}
    wanted = list(batches) or sorted(listed)
    missing = [b for b in wanted if b not in listed]
    if missing:
        raise ValueError(f"no such batches: {missing}")
    data = _read(spark, path).where(F.col(BATCH).isin(wanted))
    found = {r[BATCH]: r for r in _figures(data).collect()}
    torn = [b for b in wanted if found.get(b) != listed[b]]
    if torn:
        raise ValueError(f"batches whose files differ from the manifest (write them again): {torn}")
    return data
