"""Connected components of a link table, as DataFrame joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colline.llm.common import save


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u gets linked to the smallest of u and its neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m"))
    out = both.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    return out.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours get linked to the smallest of them (edges have u > v)."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    out = edges.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` for every end of an edge; component = the smallest node reachable.

    ``edges`` has two columns ``u, v`` of one ordered type, in any direction,
    with repeats; an edge from a node to itself says nothing.  Alternating large
    and small stars halve the distance to the smallest node, so the rounds grow
    with the logarithm of the longest path.  Each round's table is written to
    the shared folder; the driver sees two numbers a round (edges, and a hash
    to tell whether they changed).
    """
    hi, lo = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = save(edges.where(F.col("u") != F.col("v")).select(hi, lo).distinct(), f"{name}-links")
    mark = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")))
    before = now.agg(mark).first()[0]
    while before[0]:
        now = save(_small_star(_large_star(now)), f"{name}-star")
        after = now.agg(mark).first()[0]
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )
