"""Pair operators kept for parity with the reference's step-by-step API.

The scalable path (:func:`colline.operators.lines.collinear_sets`) never
materialises pairs.  These operators exist because the reference exposes its
intermediate steps (the self product, the self-pair filter, the per-pair
slope); their *output* is the pairs, so it grows as n^2 per group by
definition.  So ``group_cols`` must be given; ``()`` says that all rows are one
group.  NULL or fractional coordinates fail the job.  They are equi-joins on the group key, and a group with more pairs
than one task should take is split by anchor into buckets, exactly like the
main operator; no cartesian product operator is used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colline.functions.geometry import slope as slope_expr
from colline.operators.lines import colocated_pairs, prepare, restore_groups, split_hot, split_pairs

PAIR_COLUMNS = ("ax", "ay", "bx", "by_")


def _pairs(points, group_cols, x, y, *, distinct: bool, condition, pairs_per_task=None) -> DataFrame:
    prep = prepare(points, group_cols, x, y, distinct=distinct, pairs_per_task=pairs_per_task)
    cold, hot = split_hot(prep)
    parts = []
    if cold is not None:
        joined, _ = colocated_pairs(cold, prep.keys, prep.plan, condition)
        parts.append(joined.select(*prep.keys, *PAIR_COLUMNS))
    if hot is not None:
        joined, _ = split_pairs(hot, prep.keys, prep.plan, condition)
        parts.append(joined.select(*prep.keys, *PAIR_COLUMNS))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return restore_groups(out, prep)


def ordered_pairs(
    points: DataFrame, group_cols: str | Sequence[str], x: str = "x", y: str = "y", **kw
) -> DataFrame:
    """All ordered pairs (A, B) of distinct points, A != B, per group: n(n-1) rows.

    Duplicate input points are collapsed first (the reference makes its pairs
    distinct after the product; collapsing the points is the same result for
    n rows instead of n^2).
    """
    return _pairs(
        points, group_cols, x, y, distinct=True,
        condition=lambda ax, ay, bx, by_: (ax != bx) | (ay != by_), **kw,
    )


def half_pairs(
    points: DataFrame, group_cols: str | Sequence[str], x: str = "x", y: str = "y", **kw
) -> DataFrame:
    """Unordered pairs, A < B in (x, y) order: n(n-1)/2 rows per group."""
    from colline.functions.geometry import lex_less

    return _pairs(points, group_cols, x, y, distinct=True, condition=lex_less, **kw)


def cartesian(
    points: DataFrame, group_cols: str | Sequence[str], x: str = "x", y: str = "y", **kw
) -> DataFrame:
    """The bare product per group, self-pairs and input duplicates included: n^2 rows."""
    return _pairs(points, group_cols, x, y, distinct=False, condition=lambda *_: None, **kw)


def with_slope(pairs: DataFrame) -> DataFrame:
    """Add ``is_vertical`` and ``slope`` = (Ay - By) / (Ax - Bx) as DOUBLE.

    Vertical pairs get ``+Infinity`` (the reference used the string ``"inf"``);
    a self-pair gets NULL (the reference returned a bare ``"0"`` there, which
    its own grouping step could not handle).
    """
    dx = F.col("ax") - F.col("bx")
    dy = F.col("ay") - F.col("by_")
    return pairs.withColumn("is_vertical", (dx == 0) & (dy != 0)).withColumn("slope", slope_expr(dx, dy))
