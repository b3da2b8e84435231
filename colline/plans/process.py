"""End-to-end jobs matching the reference's top-level functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from colline.operators.anchors import collinear_sets_by_anchor
from colline.operators.lines import _as_list, collinear_sets
from colline.sources.text import parse_points, read_points, ref


def build_collinear_set(
    text: DataFrame, col: str = "value", mode: str = "strict", group_cols: str | Sequence[str] | None = None
):
    """Text lines to sorted sets, each repeated once per point (the reference's multiset).

    With ``group_cols`` (columns of ``text``) sets are found within each group.
    Permissive mode returns ``(sets, rejects)``.
    """
    gcols = _as_list(group_cols)
    parsed = parse_points(text, col, mode)
    pts, rejects = parsed if mode == "permissive" else (parsed, None)
    sets = collinear_sets_by_anchor(pts.select(*[ref(c) for c in gcols], "x", "y"), gcols)
    return (sets, rejects) if mode == "permissive" else sets


def process(
    spark: SparkSession, path: str | Sequence[str], mode: str = "strict", min_points: int = 3,
    group_cols: str | Sequence[str] | None = None,
):
    """File(s) of ``"x y"`` lines to one row per maximal collinear set.

    ``group_cols`` names partition columns of the path (``g=1/part.txt``).
    Permissive mode returns ``(sets, rejects)``; rejects name the file and block
    they come from (see :func:`colline.sources.text.read_points`).  The reference collected a
    Python set on the driver; here the de-duplicated result stays a distributed
    DataFrame (write it, or collect it in tests).
    """
    gcols = _as_list(group_cols)
    parsed = read_points(spark, path, mode, group_cols=gcols)
    pts, rejects = parsed if mode == "permissive" else (parsed, None)
    sets = collinear_sets(pts, gcols, min_points=min_points)
    return (sets, rejects) if mode == "permissive" else sets
