"""The reference's by-anchor view of the result, derived from one row per line.

The reference groups pairs by (anchor, slope): every point of a k-point line is
an anchor once, so each line comes out k times (once with each anchor first).
Here those rows are derived from the line result by exploding its points, so
the work is proportional to the output instead of to all pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colline.functions.geometry import direction_divisor, direction_key, slope
from colline.operators.lines import _as_list, collinear_sets
from colline.sources.text import ref, require


def _exploded(lines: DataFrame, group_cols: list[str]) -> DataFrame:
    vertical = F.col("ux") == 0
    quotient = slope("ux", "uy")
    # Explode an index, not the derived point array itself: keeps the
    # generator's input trivial for the optimizer.
    idx = F.explode(F.sequence(F.lit(0), F.size("points") - F.lit(1))).alias("_i")
    ex = lines.select(*group_cols, idx, vertical.alias("is_vertical"), quotient.alias("slope"), "n_points", "points")
    return ex.select(
        *group_cols,
        F.get(F.col("points"), F.col("_i")).alias("_anchor"),
        "_i",
        "is_vertical",
        "slope",
        "n_points",
        "points",
    )


def anchor_groups(
    points: DataFrame,
    group_cols: str | Sequence[str] | None = None,
    x: str = "x",
    y: str = "y",
    min_points: int = 3,
    lines: DataFrame | None = None,
) -> DataFrame:
    """One row per (anchor, slope) with ``min_points`` or more points: the anchor first,
    then its partners sorted (x, y).

    Columns: group columns, ``ax, ay, is_vertical, slope, n_points, points``.
    ``lines`` may pass an already computed :func:`collinear_sets` result.
    """
    gcols = _as_list(group_cols)
    if lines is None:
        lines = collinear_sets(points, gcols, x, y, min_points)
    ex = _exploded(lines, gcols)
    # the points before and after the anchor's place
    partners = F.concat(F.slice("points", F.lit(1), F.col("_i")), F.slice("points", F.col("_i") + 2, F.size("points")))
    return ex.select(
        *gcols,
        F.col("_anchor")["x"].alias("ax"),
        F.col("_anchor")["y"].alias("ay"),
        "is_vertical",
        "slope",
        "n_points",
        F.array_prepend(partners, F.col("_anchor")).alias("points"),
    )


def turned_pairs(pairs: DataFrame, gcols: list[str]) -> tuple[DataFrame, list[str]]:
    """(pairs of different points with ``_dx, _dy`` turned so that dx > 0, or dx = 0 and dy > 0, and the
    names of the exact direction's key columns).  A NULL coordinate fails the job."""
    whole = F.lit(True)
    for c in ("ax", "ay", "bx", "by_"):
        whole = whole & F.col(c).isNotNull()
    dx, dy = F.col("bx") - F.col("ax"), F.col("by_") - F.col("ay")
    turn = (dx < 0) | ((dx == 0) & (dy < 0))
    rows = require(pairs, whole, F.lit("a pair has a NULL coordinate")).where((dx != 0) | (dy != 0))
    own = [ref(c) for c in gcols]
    rows = rows.select(
        *own, "ax", "ay", "bx", "by_", F.when(turn, -dx).otherwise(dx).alias("_dx"), F.when(turn, -dy).otherwise(dy).alias("_dy")
    )
    rows = rows.withColumn("_div", direction_divisor("_dx", "_dy"))
    key, ux, uy = direction_key("_dx", "_dy", "_div")
    return rows.select(*own, "ax", "ay", "bx", "by_", "_dx", "_dy", key.alias("_key"), ux.alias("_ux"), uy.alias("_uy")), ["_key", "_ux", "_uy"]


def group_pairs(pairs: DataFrame, group_cols: str | Sequence[str] | None = None, min_points: int = 3) -> DataFrame:
    """Group given pairs by (anchor, slope): same columns as :func:`anchor_groups`.

    ``pairs`` has ``ax, ay, bx, by_`` (BIGINT) and the group columns.  A group
    is kept with ``min_points`` or more points that are all different: a pair
    that is given twice loses its whole group, as in the step-by-step original.
    Self pairs have no slope and are left out; a NULL coordinate fails the job.
    Slopes are compared exactly (as directions), never as rounded quotients.
    """
    gcols = _as_list(group_cols)
    rows, ray = turned_pairs(pairs, gcols)
    rows = rows.select(
        *gcols, "ax", "ay", F.struct(F.col("bx").alias("x"), F.col("by_").alias("y")).alias("_b"), *ray,
        (F.col("_dx") == 0).alias("is_vertical"), slope("_dx", "_dy").alias("slope"),
    )
    grouped = rows.groupBy(*gcols, "ax", "ay", "_key", "_ux", "_uy", "is_vertical").agg(
        F.min("slope").alias("slope"), F.collect_list("_b").alias("_partners")
    )
    enough = F.size("_partners") + 1 >= min_points
    different = F.size(F.array_distinct("_partners")) == F.size("_partners")
    anchor = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y"))
    return grouped.where(enough & different).select(
        *gcols, "ax", "ay", "is_vertical", "slope", (F.size("_partners") + 1).cast("bigint").alias("n_points"),
        F.array_prepend(F.sort_array("_partners"), anchor).alias("points"),
    )


def format_groups(groups: DataFrame) -> DataFrame:
    """The reference's ``format_result`` layout: partners first, the anchor last."""
    anchor = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y"))
    partners = F.slice(F.col("points"), 2, F.size("points"))
    return groups.withColumn("points", F.array_append(partners, anchor))


def collinear_sets_by_anchor(
    points: DataFrame,
    group_cols: str | Sequence[str] | None = None,
    x: str = "x",
    y: str = "y",
    min_points: int = 3,
    lines: DataFrame | None = None,
) -> DataFrame:
    """The reference's ``build_collinear_set`` output: each sorted set once per point of it."""
    gcols = _as_list(group_cols)
    if lines is None:
        lines = collinear_sets(points, gcols, x, y, min_points)
    return _exploded(lines, gcols).select(*gcols, "n_points", "points")
