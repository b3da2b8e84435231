"""Order-insensitive comparison of two collections of point sets (the reference's verifier).

Sets are compared by group, size and an order-free 128-bit fingerprint, built
from the points in the tasks that hold them: two xors of 64-bit hashes of
(x, y).  What is shuffled is a few numbers a set, never a point list.  Different
fingerprints prove different sets; two different sets have equal ones with a
chance of 2^-128.  :func:`set_differences` returns the whole sets, but only
those whose fingerprint the other side lacks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colline.operators.anchors import turned_pairs
from colline.operators.lines import _as_list, _hot_candidates, point_rows, prepare, restore_groups, row_lines
from colline.sources.text import ref

PRINT = ["n_points", "f1", "f2"]


def point_hashes(x: str | Column, y: str | Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a point."""
    return F.xxhash64(F.lit(1), x, y), F.xxhash64(F.lit(2), x, y)


def _xor(*values: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), values)


def set_fingerprints(
    sets: DataFrame, col: str = "points", group_cols: str | Sequence[str] | None = None, *, distinct: bool = False
) -> DataFrame:
    """``group columns, n_points, f1, f2`` of each set in an array column; repeated points count once.

    ``distinct`` says that no array repeats a point.
    """
    gcols = _as_list(group_cols)
    rows = sets.select(*[ref(c) for c in gcols], (ref(col) if distinct else F.array_distinct(ref(col))).alias("_set"))
    zero = F.lit(0).cast("bigint")

    def folded(k: int) -> Column:
        return F.aggregate("_set", zero, lambda acc, p: acc.bitwiseXOR(point_hashes(p["x"], p["y"])[k]))

    return rows.select(*[ref(c) for c in gcols], F.size("_set").cast("bigint").alias("n_points"), folded(0).alias("f1"), folded(1).alias("f2"))


def pair_fingerprints(pairs: DataFrame, group_cols: str | Sequence[str] | None = None, min_points: int = 3) -> DataFrame:
    """Fingerprints of given pairs grouped by (anchor, slope), one row per group of enough points.

    The sets are those of :func:`colline.group_pairs`, without building them.
    ``pairs`` are distinct (as :func:`colline.ordered_pairs` gives them).
    """
    gcols = _as_list(group_cols)
    rows, ray = turned_pairs(pairs, gcols)
    b1, b2 = point_hashes("bx", "by_")
    a1, a2 = point_hashes("ax", "ay")
    rows = rows.select(*[ref(c) for c in gcols], "ax", "ay", *ray, b1.alias("_b1"), b2.alias("_b2"))
    grouped = rows.groupBy(*[ref(c) for c in gcols], "ax", "ay", *ray).agg(
        F.count(F.lit(1)).alias("_n"), F.bit_xor("_b1").alias("_b1"), F.bit_xor("_b2").alias("_b2")
    )
    grouped = grouped.where(F.col("_n") + 1 >= min_points)
    return grouped.select(
        *[ref(c) for c in gcols], (F.col("_n") + 1).alias("n_points"), _xor(F.col("_b1"), a1).alias("f1"), _xor(F.col("_b2"), a2).alias("f2")
    )


def line_fingerprints(
    points: DataFrame, group_cols: str | Sequence[str] | None = None, x: str = "x", y: str = "y", min_points: int = 3, **sizing
) -> DataFrame:
    """Fingerprints of the lines :func:`colline.collinear_sets` finds, one row per line.

    The lines of a group in one row are hashed where they are found.  Of larger
    groups a candidate adds its anchor, and the one with two partners these as
    well, so a line's fingerprint is an xor over candidates: numbers only.
    """
    prep = prepare(points, group_cols, x, y, **sizing)
    rows, rest = point_rows(prep)
    parts = [set_fingerprints(row_lines(r, prep, min_points), "points", prep.keys, distinct=True) for r in rows]
    if rest is not None:
        cand, dir_cols = _hot_candidates(rest, prep)
        ends = [_xor(a, b) for a, b in zip(point_hashes("_nx", "_ny"), point_hashes("_lx", "_ly"))]
        own = [_xor(a, F.when(F.col("_cnt") == 2, e).otherwise(F.lit(0).cast("bigint"))) for a, e in zip(point_hashes("ax", "ay"), ends)]
        cand = cand.select(*prep.keys, *dir_cols, "_lx", "_ly", "_cnt", own[0].alias("_f1"), own[1].alias("_f2"))
        part = cand.groupBy(*prep.keys, *dir_cols, "_lx", "_ly").agg(
            (F.max("_cnt") + 1).alias("n_points"), F.bit_xor("_f1").alias("f1"), F.bit_xor("_f2").alias("f2")
        )
        parts.append(part.where(F.col("n_points") >= min_points).select(*prep.keys, *PRINT))
    return restore_groups(reduce(lambda a, b: a.unionByName(b), parts), prep)


def _compared(left: DataFrame, right: DataFrame, gcols: list[str]) -> DataFrame:
    """One row per group and fingerprint, with whether each side has it (``_l``, ``_r``: 0 or 1)."""
    names = [f"_k{i}" for i in range(len(gcols))]
    side = lambda df, k: df.select(*[ref(c).alias(n) for c, n in zip(gcols, names)], *PRINT, F.lit(k).alias("_side"))
    both = side(left, 1).unionByName(side(right, 2))
    return both.groupBy(*names, *PRINT).agg(
        F.max((F.col("_side") == 1).cast("int")).alias("_l"), F.max((F.col("_side") == 2).cast("int")).alias("_r")
    )


def fingerprint_difference_counts(left: DataFrame, right: DataFrame, group_cols: str | Sequence[str] | None = None) -> DataFrame:
    """One row: ``n_left, n_right, n_only_left, n_only_right`` over distinct (group, fingerprint)."""
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)
    left_, right_ = F.col("_l"), F.col("_r")
    return _compared(left, right, _as_list(group_cols)).agg(
        total(left_, "n_left"), total(right_, "n_right"), total(left_ * (1 - right_), "n_only_left"), total(right_ * (1 - left_), "n_only_right")
    )


def set_difference_counts(
    left: DataFrame, right: DataFrame, col: str = "points", group_cols: str | Sequence[str] | None = None
) -> DataFrame:
    """One row: ``n_left, n_right, n_only_left, n_only_right`` over the distinct sets of each group.

    One shuffle of fingerprints; no join, no point list, nothing on the driver.
    """
    return fingerprint_difference_counts(set_fingerprints(left, col, group_cols), set_fingerprints(right, col, group_cols), group_cols)


def set_differences(
    left: DataFrame, right: DataFrame, col: str = "points", group_cols: str | Sequence[str] | None = None
) -> DataFrame:
    """The sets only one side has: ``group columns, side ('left' or 'right'), points`` (sorted).

    Whole sets are read only for fingerprints the other side lacks.
    """
    gcols = _as_list(group_cols)
    names = [f"_k{i}" for i in range(len(gcols))]
    uneven = _compared(set_fingerprints(left, col, gcols), set_fingerprints(right, col, gcols), gcols).where("_l <> _r")
    out = None
    for df, side, has in ((left, "left", "_l"), (right, "right", "_r")):
        sets = df.select(*[ref(c).alias(k) for c, k in zip(gcols, names)], F.sort_array(F.array_distinct(ref(col))).alias("points"))
        own = F.struct(*[F.col(c) for c in [*names, "points"]]).alias("_s")
        marked = set_fingerprints(sets.select(*names, "points", own), "points", [*names, "_s"])
        only = uneven.where(F.col(has) == 1).select(*[F.col(c).alias(c + "_u") for c in [*names, *PRINT]])
        same = reduce(lambda a, b: a & b, [marked[c].eqNullSafe(only[c + "_u"]) for c in [*names, *PRINT]])
        part = marked.join(only, same, "left_semi").select(*names, F.lit(side).alias("side"), F.col("_s.points").alias("points")).distinct()
        out = part if out is None else out.unionByName(part)
    return out.select(*[F.col(k).alias(c) for k, c in zip(names, gcols)], "side", "points")


def same_sets(left: DataFrame, right: DataFrame, col: str = "points", group_cols: str | Sequence[str] | None = None) -> bool:
    """True when both hold the same sets, ignoring order inside and between sets."""
    row = set_difference_counts(left, right, col, group_cols).first()
    return row["n_only_left"] == 0 and row["n_only_right"] == 0
