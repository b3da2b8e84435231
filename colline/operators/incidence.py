"""Lookups of points on given lines, and what is built on them.

* :func:`points_on_lines`: for each given line (or pair of points, through
  :func:`lines_through`) all points on it.  In small groups a point is tested
  against every line of its group, where both are, and only hits go on.  In
  others it meets every distinct direction of its group's lines and emits one
  exact key (direction, c); the keys are equi-joined with the lines.  Points
  never meet points.
* :func:`rich_lines`: lines of at least k points by the pigeonhole principle.
  Points are dealt into m buckets; a line of k points has ceil(k / m) of them in
  one bucket, so a search inside the buckets (n^2 / m pairs) finds every such
  line, and the lookup above completes and counts it.
* :func:`extend_lines`: the lines after points were added, from the lines
  before.  Only pairs with a new point are formed.

The work (points times directions, new points times points) is measured before
the plan is built, as in :mod:`colline.operators.workload`.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colline.functions.geometry import direction_divisor, direction_key, gcd_bounded, int_div, points_text
from colline.operators.lines import Prepared, _as_list, _flat_keys, candidates_of, distinct_points, point_rows, prepare, prepared, restore_groups, row_lines, swept
from colline.sources.storage import materialize_always
from colline.sources.text import ref
from colline.operators.workload import (
    BROADCAST_MAX_BYTES,
    CONF_BROADCAST_MAX_BYTES,
    CONF_PAIRS_PER_TASK,
    MAX_PARTITIONS,
    MIN_PAIRS_PER_TASK,
    PAIRS_PER_TASK,
    POINT_BYTES,
    SPLIT_BUCKETS_PER_CORE,
    _conf_int,
    parallelism,
)

LINE = ["ux", "uy", "c"]
# Coordinates are at most 2^61 in size (see README), directions at most their differences.
MAX_DIFFERENCE = 1 << 62
# Points are tested against lines, not directions, while this costs less than so many
# tests a row (of points and lines) in all, and so many in any group.
TESTS_PER_ROW = 64
TESTS_PER_GROUP = 1 << 26


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], suffix: str = "") -> Column:
    """Null-safe equality of key columns (NULL is a group of its own)."""
    out = left[keys[0]].eqNullSafe(right[keys[0] + suffix])
    for k in keys[1:]:
        out = out & left[k].eqNullSafe(right[k + suffix])
    return out


def _renamed(df: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c + suffix if c in keys else c) for c in df.columns])


def _zero(cols: Sequence[str]) -> Column:
    """0 in every row, but not a constant to the optimizer (a constant key would make the join a product)."""
    return F.shiftright(F.hash(*cols).cast("bigint").bitwiseAND(F.lit(0x7FFFFFFF)), 31)


class GroupWork:
    """Measured size of a join inside groups: left rows times right rows, and the right side's bytes."""

    def __init__(
        self, left: DataFrame, right: DataFrame, keys: list[str], left_max: Column, right_max: Column, bound: int | None, row_bytes: int = POINT_BYTES
    ):
        spark = left.sparkSession
        a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(left_max).alias("_m"))
        b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d"), F.max(right_max).alias("_u"))
        width = F.lit(row_bytes)
        for k in keys:
            width = width + F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) + F.lit(8)
        if keys:
            b = _renamed(b.withColumn("_w", F.col("_d") * width), keys, "_b")
            both = a.join(b, _same(a, b, keys, "_b"))
        else:
            b = b.withColumn("_w", F.col("_d") * width).withColumn("_z_b", _zero(["_d"]))
            a = a.withColumn("_z", _zero(["_n"]))
            both = a.join(b, F.col("_z") == F.col("_z_b"))
        work = F.col("_n") * F.col("_d")
        sums = (F.sum(work), F.sum("_w"), F.max("_m"), F.max("_u"), F.max(work), F.sum(F.col("_n") + F.col("_d")))
        row = both.agg(*[F.coalesce(x, F.lit(0)) for x in sums]).first()
        self.work, self.bytes, self.left_max, self.right_max, self.most, self.rows = (int(v) for v in row)
        cores = parallelism(spark)
        per_task = _conf_int(spark, CONF_PAIRS_PER_TASK, PAIRS_PER_TASK)
        self.partitions = max(1, min(math.ceil(self.work / per_task), MAX_PARTITIONS), min(2 * cores, math.ceil(self.work / MIN_PAIRS_PER_TASK)))
        self.bound = _conf_int(spark, CONF_BROADCAST_MAX_BYTES, BROADCAST_MAX_BYTES) if bound is None else bound
        self.broadcast = self.bytes <= self.bound
        self.buckets = min(self.partitions, SPLIT_BUCKETS_PER_CORE * cores)


def group_join(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], plan: GroupWork) -> DataFrame:
    """Every left row with every right row of its group, as an equi-join.

    Within the measured byte bound the right side is broadcast and the left one
    dealt out by (keys, ``spread``).  Beyond it both sides are co-partitioned by
    the keys (skewed groups are split at run time); without keys the left rows
    go to buckets that each get a copy of the right side.
    """
    names = keys or ["_zero"]
    if not keys:
        left = left.withColumn("_zero", _zero(spread))
        right = right.withColumn("_zero", _zero(right.columns[:2]))
    right = _renamed(right, names, "_r")
    if plan.broadcast:
        # size-checked: the measured bytes are within the bound
        left = left.repartition(plan.partitions, *keys, *spread)
        out = left.join(F.broadcast(right), _same(left, right, names, "_r"))
    elif keys:
        out = left.join(right.hint("merge"), _same(left, right, names, "_r"))
    else:
        left = left.withColumn("_bucket", F.pmod(F.xxhash64(*spread), F.lit(plan.buckets)))
        right = right.withColumn("_bucket_r", F.explode(F.sequence(F.lit(0), F.lit(plan.buckets - 1)).cast("array<bigint>")))
        out = left.join(right.hint("merge"), F.col("_bucket") == F.col("_bucket_r"))
    return out.drop(*[n + "_r" for n in names], "_zero", "_bucket", "_bucket_r")


def _difference(ax: str, ay: str, bx: str, by: str) -> list[Column]:
    """``_dx, _dy`` between two different points, turned so that dx > 0, or dx = 0 and dy > 0."""
    dx, dy = F.col(bx) - F.col(ax), F.col(by) - F.col(ay)
    back = (dx < 0) | ((dx == 0) & (dy < 0))
    return [F.when(back, -dx).otherwise(dx).alias("_dx"), F.when(back, -dy).otherwise(dy).alias("_dy")]


def _with_line(df: DataFrame, ax: str, ay: str, bx: str, by: str, keep: Sequence[str], bound: int = MAX_DIFFERENCE) -> DataFrame:
    """``keep`` columns and the exact line key through (ax, ay) and (bx, by)."""
    rows = df.select(*keep, F.col(ax).alias("_ax"), F.col(ay).alias("_ay"), *_difference(ax, ay, bx, by))
    # the optimizer may move conditions on the key before the filter that drops equal points: never divide by 0
    rows = rows.withColumn("_d", F.greatest(gcd_bounded(F.col("_dx"), F.abs(F.col("_dy")), bound), F.lit(1).cast("bigint")))
    rows = rows.select(*keep, int_div("_dx", "_d").alias("ux"), int_div("_dy", "_d").alias("uy"), "_ax", "_ay")
    return rows.select(*keep, "ux", "uy", _constant("_ax", "_ay", False).alias("c"))


def _constant(x: str, y: str, small: bool) -> Column:
    """ux*y - uy*x, as BIGINT where the sizes allow, else DECIMAL(38,0)."""
    if small:
        return F.col("ux") * F.col(y) - F.col("uy") * F.col(x)
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    return (wide("ux") * wide(y) - wide("uy") * wide(x)).cast("decimal(38,0)")


def lines_through(
    pairs: DataFrame, group_cols: str | Sequence[str] | None = None, ax: str = "ax", ay: str = "ay", bx: str = "bx", by: str = "by_"
) -> DataFrame:
    """Distinct exact keys ``group columns, ux, uy, c`` of the lines through given pairs of points.

    Pairs of equal points name no line and are left out.
    """
    gcols = _as_list(group_cols)
    keys = _flat_keys(gcols)
    named = pairs.select(*[ref(c).alias(k) for c, k in zip(gcols, keys)], *[F.col(c).cast("bigint").alias(n) for c, n in zip((ax, ay, bx, by), ("_ax", "_ay", "_bx", "_by"))])
    apart = (F.col("_ax") != F.col("_bx")) | (F.col("_ay") != F.col("_by"))
    out = _with_line(named.where(apart), "_ax", "_ay", "_bx", "_by", keys).distinct()
    return out.select(*[F.col(k).alias(c) for k, c in zip(keys, gcols)], *LINE)


def _members(pts: DataFrame, lines: DataFrame, keys: list[str], bound: int | None) -> tuple[DataFrame, GroupWork]:
    """``keys, ux, uy, c, x, y`` of distinct points on distinct lines (internal key names).

    The line keys are written to the checkpoint folder first: they are counted,
    reduced to directions and joined, and must not be searched for each time.
    """
    lines = materialize_always(lines, "line-keys")
    limits = F.greatest(F.abs("x"), F.abs("y")), F.greatest(F.col("ux"), F.abs("uy"))
    if keys:
        plan = GroupWork(pts, lines, keys, *limits, bound, POINT_BYTES + 24)
        if plan.work <= TESTS_PER_ROW * plan.rows and plan.most <= TESTS_PER_GROUP:
            return _tested(pts, lines, keys, plan), plan
    dirs = lines.select(*keys, "ux", "uy").distinct()
    plan = GroupWork(pts, dirs, keys, *limits, bound)
    small = _fits_bigint(plan)
    emitted = group_join(pts, dirs, keys, ["x", "y"], plan)
    emitted = emitted.select(*keys, "ux", "uy", "x", "y", _constant("x", "y", small).alias("c"))
    known = lines.select(*keys, "ux", "uy", (F.col("c").try_cast("bigint") if small else F.col("c").cast("decimal(38,0)")).alias("c"))
    cols = [*keys, *LINE]
    known = _renamed(known, cols, "_l")
    # a line's row is a direction's row and a constant: broadcast by the same kind of measure
    n_lines = lines.count() if plan.broadcast else None
    if n_lines is not None and n_lines * (POINT_BYTES + 24 + 16 * len(keys)) <= plan.bound:
        known = F.broadcast(known)
    on = _same(emitted, known, keys, "_l") if keys else None
    for k in LINE:
        same = emitted[k] == known[k + "_l"]
        on = same if on is None else on & same
    out = emitted.join(known, on).select(*keys, "ux", "uy", F.col("c").cast("decimal(38,0)").alias("c"), "x", "y")
    return out, plan


def _fits_bigint(plan: GroupWork) -> bool:
    return 2 * plan.left_max * plan.right_max < 1 << 62


def _tested(pts: DataFrame, lines: DataFrame, keys: list[str], plan: GroupWork) -> DataFrame:
    """:func:`_members` by a join on the group alone: both sides move once, and what is on no line goes no further."""
    small = _fits_bigint(plan)
    # a constant that is no BIGINT where all of them are is NULL, and meets no point
    c = F.col("c").try_cast("bigint") if small else F.col("c").cast("decimal(38,0)")
    met = group_join(pts, lines.select(*keys, "ux", "uy", c.alias("c")), keys, ["x", "y"], plan)
    met = met.where(_constant("x", "y", small) == F.col("c"))
    return met.select(*keys, "ux", "uy", F.col("c").cast("decimal(38,0)").alias("c"), "x", "y")


def _named_lines(lines: DataFrame, gcols: list[str], keys: list[str]) -> DataFrame:
    return lines.select(*[ref(c).alias(k) for c, k in zip(gcols, keys)], "ux", "uy", F.col("c").cast("decimal(38,0)").alias("c")).distinct()


def points_on_lines(
    points: DataFrame, lines: DataFrame, group_cols: str | Sequence[str] | None = None, x: str = "x", y: str = "y", *,
    broadcast_max_bytes: int | None = None, return_plan: bool = False,
):
    """Every point on every given line: rows ``group columns, ux, uy, c, x, y``.

    ``lines`` has the group columns and exact keys ``ux, uy, c`` as
    :func:`colline.collinear_sets` and :func:`lines_through` give them; repeated
    lines and points count once, a line without points has no rows.  Distinct
    directions are broadcast by their measured bytes, else co-partitioned.
    """
    gcols = _as_list(group_cols)
    keys = _flat_keys(gcols)
    out, plan = _members(distinct_points(points, gcols, x, y), _named_lines(lines, gcols, keys), keys, broadcast_max_bytes)
    out = out.select(*[F.col(k).alias(c) for k, c in zip(keys, gcols)], *LINE, "x", "y")
    return (out, plan) if return_plan else out


def line_sets(members: DataFrame, group_cols: str | Sequence[str] | None = None, min_points: int = 1) -> DataFrame:
    """One row per line from rows of :func:`points_on_lines`: ``group columns, ux, uy, c, n_points, points``."""
    cols = [*_as_list(group_cols), *LINE]
    sets = members.groupBy(*cols).agg(
        F.count(F.lit(1)).alias("n_points"), F.sort_array(F.collect_list(F.struct("x", "y"))).alias("points")
    )
    return sets.where(F.col("n_points") >= min_points)


# ---- lines of many points ------------------------------------------------------------------


def pigeonhole(min_points: int) -> tuple[int, int]:
    """(buckets m, points s in one of them) for lines of at least ``min_points``: s = ceil(k / m).

    More buckets form fewer pairs, but a small s leaves many chance lines to
    look up, so m is the largest with s >= 5, and 2 where there is none.
    """
    best = max((m for m in range(1, min_points) if math.ceil(min_points / m) >= 5), default=1)
    if best == 1 and min_points >= 5:
        best = 2
    return best, math.ceil(min_points / best)


def rich_lines(
    points: DataFrame, min_points: int, group_cols: str | Sequence[str] | None = None, x: str = "x", y: str = "y", *,
    buckets: int | None = None, broadcast_max_bytes: int | None = None, text: bool = False,
) -> DataFrame:
    """Lines of at least ``min_points`` points, in the columns of :func:`colline.collinear_sets` (with its ``text``).

    Searches lines of s points inside m buckets of each group (see
    :func:`pigeonhole`) and looks up all points on what is found.  ``buckets``
    sets m; s follows from it and must be 3 or more.  While a group's points fit
    one row, both steps are made where the row is, and no line leaves its task
    before it is whole; for larger groups the lines found are joined with the points.
    One set of points that is dense in its box is searched by the directions that
    k points of a line leave room for (:mod:`colline.operators.sweep`), if these are
    less work than the pairs inside the buckets.
    """
    m, s = pigeonhole(min_points) if buckets is None else (buckets, math.ceil(min_points / buckets))
    if s < 3:
        raise ValueError(f"{min_points} points in {m} buckets leave {s} in one; at least 3 are needed")
    gcols = _as_list(group_cols)
    keys = _flat_keys(gcols)
    dealt = distinct_points(points, gcols, x, y).withColumn("_in", F.pmod(F.xxhash64("x", "y"), F.lit(m)))
    prep = prepared(dealt, gcols, broadcast_max_bytes=broadcast_max_bytes)
    out = swept(prep, min_points, prep.plan.n_points**2 // m, text) if buckets is None else None
    if out is not None:
        return out
    rows, rest = point_rows(prep, ["_in"])
    for r in rows:
        part = _flat_named(row_lines(r, prep, min_points, s), prep, keys)
        out = part if out is None else out.unionByName(part)
    if rest is not None:
        part = _rich_by_lookup(_flat_named(rest, prep, keys).select(*keys, "x", "y", "_in"), keys, min_points, s, broadcast_max_bytes)
        out = part if out is None else out.unionByName(part)
    out = out.select(*[F.col(k).alias(c) for k, c in zip(keys, gcols)], *LINE, "n_points", "points")
    return out.withColumn("points", points_text("points")) if text else out


def _flat_named(df: DataFrame, prep: Prepared, keys: list[str]) -> DataFrame:
    """``df`` with the key columns of :func:`colline.operators.lines.prepared` one by one."""
    if prep.keys == keys:
        return df
    return df.select(*[F.col("_gk")[k].alias(k) for k in keys], *[c for c in df.columns if c != "_gk"])


def _rich_by_lookup(dealt: DataFrame, keys: list[str], min_points: int, share: int, bound: int | None) -> DataFrame:
    prep = prepare(dealt, [*keys, "_in"], "x", "y", distinct=False, broadcast_max_bytes=bound)
    found = None
    for cand, _, _ in candidates_of(prep):
        # the first point of a line of s points in a bucket has s - 1 partners; no other candidate is needed
        first = restore_groups(cand.where(F.col("_cnt") >= share - 1).select(*prep.keys, "ax", "ay", "_lx", "_ly"), prep)
        part = _with_line(first, "ax", "ay", "_lx", "_ly", keys)
        found = part if found is None else found.unionByName(part)
    members, _ = _members(dealt.drop("_in"), found.distinct(), keys, bound)
    return line_sets(members, keys, min_points)


# ---- lines after points were added ------------------------------------------------------------


def delta_pairs(new: DataFrame, everything: DataFrame, keys: list[str], bound: int | None = None) -> DataFrame:
    """``keys, ax, ay, bx, by_``: every new point with every other point of its group."""
    coordinates = F.greatest(F.abs("x"), F.abs("y"))
    plan = GroupWork(new, everything, keys, coordinates, coordinates, bound)
    anchors = new.select(*keys, F.col("x").alias("ax"), F.col("y").alias("ay"))
    partners = everything.select(*keys, F.col("x").alias("bx"), F.col("y").alias("by_"))
    pairs = group_join(anchors, partners, keys, ["ax", "ay"], plan)
    return pairs.where((F.col("ax") != F.col("bx")) | (F.col("ay") != F.col("by_")))


def extend_lines(
    lines: DataFrame, points: DataFrame, new_points: DataFrame, group_cols: str | Sequence[str] | None = None,
    x: str = "x", y: str = "y", min_points: int = 3, *, broadcast_max_bytes: int | None = None,
) -> DataFrame:
    """The lines of ``points`` and ``new_points`` together, given the ``lines`` of ``points``.

    Same columns as ``lines`` (:func:`colline.collinear_sets`, with the same
    ``min_points``).  A line changes or appears only if it holds a new point, so
    pairs are formed with new points only: ``min_points - 1`` or more partners
    in one direction are a changed line, given out by its lowest new point; all
    other lines pass through.  New points that were there before change nothing.
    """
    if min_points < 3:
        raise ValueError("min_points must be at least 3 (any two points share a line)")
    gcols = _as_list(group_cols)
    keys = _flat_keys(gcols)
    parts = [distinct_points(p, gcols, x, y, distinct=False).withColumn("_lead", F.lit(new)) for p, new in ((points, False), (new_points, True))]
    everything = parts[0].unionByName(parts[1]).groupBy(*keys, "x", "y").agg(F.bool_and("_lead").alias("_lead"))
    prep = prepared(everything, gcols, broadcast_max_bytes=broadcast_max_bytes)
    rows, rest = point_rows(prep, ["_lead"])
    changed = None
    for r in rows:
        part = _flat_named(row_lines(r, prep, min_points), prep, keys)
        changed = part if changed is None else changed.unionByName(part)
    if rest is not None:
        part = _changed_by_lookup(_flat_named(rest, prep, keys), keys, min_points, broadcast_max_bytes)
        changed = part if changed is None else changed.unionByName(part)
    # read twice below
    changed = materialize_always(changed, "changed-lines")
    before = lines.select(*[ref(c).alias(k) for c, k in zip(gcols, keys)], *LINE, "n_points", "points")
    gone = changed.select(*[F.col(c).alias(c + "_t") for c in [*keys, *LINE]])
    out = before.join(gone, _same(before, gone, [*keys, *LINE], "_t"), "left_anti").unionByName(changed)
    return out.select(*[F.col(k).alias(c) for k, c in zip(keys, gcols)], *LINE, "n_points", "points")


def _changed_by_lookup(everything: DataFrame, keys: list[str], min_points: int, bound: int | None) -> DataFrame:
    """The lines with a new point (``_lead``) of groups too large for a row, by a join of the lines found and the points."""
    added, everything = everything.where("_lead").select(*keys, "x", "y"), everything.select(*keys, "x", "y")
    rows = delta_pairs(added, everything, keys, bound).select(*keys, "ax", "ay", "bx", "by_", *_difference("ax", "ay", "bx", "by_"))
    rows = rows.withColumn("_div", direction_divisor("_dx", "_dy"))
    slope, ux, uy = direction_key("_dx", "_dy", "_div")
    rays = (
        rows.select(*keys, "ax", "ay", "bx", "by_", slope.alias("_slope"), ux.alias("_eux"), uy.alias("_euy"))
        .groupBy(*keys, "ax", "ay", "_slope", "_eux", "_euy")
        .agg(F.count(F.lit(1)).alias("_n"), F.min(F.col("bx")).alias("_bx"), F.min_by("by_", F.col("bx")).alias("_by"))
        .where(F.col("_n") >= min_points - 1)
    )
    # any partner will do: all of a ray are on its line
    touched = _with_line(rays, "ax", "ay", "_bx", "_by", keys).distinct()
    return line_sets(_members(everything, touched, keys, bound)[0], keys, min_points)
