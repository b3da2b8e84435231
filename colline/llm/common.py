"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colline.sources.storage import materialize_always

# A word: code points other than space and the ASCII controls tab to CR.
WORD = r"[^\x20\x09-\x0D]+"

# Rows up to which a small side is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and reread: lineage ends there, several jobs share it."""
    return materialize_always(df, f"llm-{name}")


def small_side(saved: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the saved table has at most ``max_rows`` rows, else the table as it is.

    Pass narrow tables only (a few fixed-width columns), so the row bound is a byte bound.
    """
    return F.broadcast(saved) if saved.count() <= max_rows else saved


def word_count(text: Column) -> Column:
    """Number of words (:data:`WORD`) of a text, JVM-side; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def per_batch(fn: Callable[[dict[str, list]], dict[str, list]], schema: pa.Schema):
    """A ``mapInArrow`` function from one on columns as Python lists, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch.to_pydict())
                yield pa.RecordBatch.from_pydict({f.name: pa.array(out[f.name], f.type) for f in schema}, schema=schema)

    return run
