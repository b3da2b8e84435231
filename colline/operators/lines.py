"""Maximal collinear point sets, one row per line: the engine's main operator.

One dense set of points is searched by direction (:mod:`colline.operators.sweep`).
Groups whose points fit a row are searched on arrays (:mod:`colline.operators.rays`);
the candidates below serve hot groups beyond the broadcast bound and the operators
that need them.  Plan (no cartesian product, and nothing on the driver but one row
of sizes and size-checked broadcasts):

1. distinct points per group (partial + final aggregate: duplicates collapse
   map-side before the shuffle);
2. one sizing job (:mod:`colline.operators.workload`) measures the quadratic
   pair workload per group and the coordinate range;
3. half pairs (a < b in x, y order) by an equi-join on the group key, and in
   the *same stage* an aggregate per (anchor, direction): count and the
   nearest / farthest partner.  Pairs are never shuffled or stored; only
   anchors of lines with three or more points leave the stage ("candidates");
4. a line's candidates share (group, direction, farthest point); every point
   but the last two is the anchor of exactly one candidate, the last-but-one
   is the nearest partner of the candidate with count 2, the last one the
   farthest partner.  So the line is assembled from its candidates alone;
5. exact integer key ``(ux, uy, c)``: primitive direction (ux > 0, or (0, 1)
   when vertical) and c = ux*y - uy*x, equal for every point of the line.

Two layouts for steps 3-4:

* co-located (groups below the per-task pair budget): anchors are
  hash-partitioned by group, partners come from a size-checked broadcast or a
  co-partitioned copy; both aggregates group by keys that contain the group
  key, so the whole line search runs in one stage after one shuffle of points;
* split (hot groups, and the no-group case): anchors are hash-partitioned by
  (group, anchor) and meet a size-checked broadcast of their group's points;
  beyond the bound they go to a few buckets per core that each get a copy of
  the points.  Line assembly then needs one shuffle of the candidates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colline.functions.geometry import (
    EXACT_DOUBLE_BOUND,
    INFINITY,
    direction_divisor,
    direction_key,
    int_div,
    lex_less,
    gcd_bounded,
    points_text,
)
from colline.operators.rays import array_lines, rows_by_group, rows_by_share
from colline.operators.sweep import sweep_lines, sweeps
from colline.operators.workload import PairWorkload, group_sizes, hot_group_buckets, measure
from colline.sources.storage import materialize
from colline.sources.text import points_from, ref, split_points

# Coordinates below this bound give differences below EXACT_DOUBLE_BOUND, so the
# double slope alone is an exact direction key.
SMALL_COORD_BOUND = EXACT_DOUBLE_BOUND // 2

# Fixed values of the packed point form used when coordinates are small:
# p = x * 2**32 + (y + 2**31).  Numeric order of p is (x, y) order, so on a ray
# from an anchor the nearest / farthest partner are min(p) / max(p).
PACK_SHIFT = 32
PACK_OFFSET = 1 << 31
PACK_MASK = (1 << 32) - 1


def pack_point(x: Column, y: Column) -> Column:
    return x.cast("bigint") * F.lit(1 << PACK_SHIFT) + (y.cast("bigint") + F.lit(PACK_OFFSET))


def unpack_x(p: Column) -> Column:
    return F.shiftright(p, PACK_SHIFT)


def unpack_y(p: Column) -> Column:
    return p.bitwiseAND(F.lit(PACK_MASK)) - F.lit(PACK_OFFSET)


def _as_list(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def _and(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


@dataclass
class Prepared:
    """Distinct points with internal group key columns, and the sizing result."""

    pts: DataFrame
    keys: list[str]
    group_cols: list[str]
    plan: PairWorkload
    sizes: DataFrame


def _flat_keys(group_cols: list[str]) -> list[str]:
    return [f"_g{i}" for i in range(len(group_cols))]


def distinct_points(
    points: DataFrame, group_cols: Sequence[str] = (), x: str = "x", y: str = "y", distinct: bool = True
) -> DataFrame:
    """``_g0.., x BIGINT, y BIGINT``, one row per distinct point of each group.

    A NULL, fractional or out-of-range coordinate fails the job (see
    :func:`colline.sources.text.points_from`).
    """
    gcols = _as_list(group_cols)
    named = points.select(
        *[ref(c).alias(k) for c, k in zip(gcols, _flat_keys(gcols))], ref(x).alias("_x"), ref(y).alias("_y")
    )
    out = points_from(named, "_x", "_y", _flat_keys(gcols))
    return out.dropDuplicates() if distinct else out


def prepare(
    points: DataFrame,
    group_cols: str | Sequence[str] | None,
    x: str,
    y: str,
    *,
    distinct: bool = True,
    pairs_per_task: int | None = None,
    broadcast_max_bytes: int | None = None,
    allow_broadcast: bool = True,
    materialize_points: bool = False,
) -> Prepared:
    gcols = _as_list(group_cols)
    pts = distinct_points(points, gcols, x, y, distinct)
    if materialize_points:
        pts = materialize(pts, "points")
    return prepared(
        pts, gcols, pairs_per_task=pairs_per_task, broadcast_max_bytes=broadcast_max_bytes, allow_broadcast=allow_broadcast
    )


def prepared(pts: DataFrame, gcols: list[str], **sizing) -> Prepared:
    """Distinct points (``_g0.., x, y``) with the result of the sizing job."""
    keys = _flat_keys(gcols)
    plan, sizes = measure(pts, keys, **sizing)
    if plan.null_key_groups:
        # NULL is a group of its own, as in GROUP BY; plain equality would drop
        # it, so the key columns travel as one (never NULL) struct.
        pts = pts.select(F.struct(*keys).alias("_gk"), *[c for c in pts.columns if c not in keys])
        keys = ["_gk"]
        sizes = group_sizes(pts, keys)
    return Prepared(pts, keys, gcols, plan, sizes)


def restore_groups(df: DataFrame, prep: Prepared) -> DataFrame:
    """Internal key columns back to the caller's group column names, first.

    A group column with the name of an output column raises: the result could
    not be read by name or written.
    """
    if not prep.group_cols:
        return df
    clash = sorted(set(prep.group_cols) & (set(df.columns) - set(prep.keys)))
    if clash:
        raise ValueError(f"group columns {clash} have names of output columns; rename them")
    rest = [c for c in df.columns if c not in prep.keys]
    if prep.keys == ["_gk"]:
        outs = [F.col("_gk")[k].alias(c) for k, c in zip(_flat_keys(prep.group_cols), prep.group_cols)]
    else:
        outs = [F.col(k).alias(c) for k, c in zip(prep.keys, prep.group_cols)]
    return df.select(*outs, *rest)


# ---- step 3: pairs ----------------------------------------------------------------------


def _pair_join(anchors: DataFrame, partners: DataFrame, eq: list[Column], extra: Column | None) -> DataFrame:
    return anchors.join(partners, _and(eq + ([extra] if extra is not None else [])), "inner")


def _anchor_cols(packed: bool) -> list[Column]:
    if packed:
        return [pack_point(F.col("x"), F.col("y")).alias("_a")]
    return [F.col("x").alias("ax"), F.col("y").alias("ay")]


def _partner_cols(packed: bool) -> list[Column]:
    if packed:
        return [pack_point(F.col("x"), F.col("y")).alias("_b")]
    return [F.col("x").alias("bx"), F.col("y").alias("by_")]


def _condition(condition, packed: bool) -> Column | None:
    if packed:  # packed order is (x, y) order; only the half-pair condition is packed
        return F.col("_b") > F.col("_a")
    return condition(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by_"))


def colocated_pairs(pts: DataFrame, keys: list[str], plan: PairWorkload, condition=lex_less, packed: bool = False):
    """Pairs of groups small enough for one task each; partitioned by the group key."""
    extra = _condition(condition, packed)
    by_group = pts.repartition(plan.partitions, *keys)
    anchors = by_group.select(*keys, *_anchor_cols(packed))
    if plan.broadcast:
        # size-checked: the measured bytes are within the bound
        partners = F.broadcast(pts.select(*[F.col(k).alias(k + "_b") for k in keys], *_partner_cols(packed)))
    else:
        # the same exchange as the anchors (Spark reuses it): one shuffle of points
        partners = by_group.select(*[F.col(k).alias(k + "_b") for k in keys], *_partner_cols(packed)).hint("merge")
    eq = [F.col(k) == F.col(k + "_b") for k in keys]
    return _pair_join(anchors, partners, eq, extra), list(keys)


# Candidate labels scanned per bucket slot when looking for labels that hash to
# distinct partitions (coupon collector: about ln(slots) per slot are needed).
LABEL_CANDIDATES_PER_SLOT = 24


def bucket_labels(spark, slots: int) -> DataFrame:
    """``(_slot, _label)``: for every slot 0..slots-1 a BIGINT label that
    ``repartition(slots, label)`` sends to partition ``_slot``.

    Hash partitioning of a handful of small bucket ids collides (several
    buckets in one task, others idle); labels found with Spark's own ``hash``
    give every bucket its own task.  This only affects balance: a slot without
    a label found falls back to a colliding label, never to a wrong result.
    """
    found = (
        spark.range(0, slots * LABEL_CANDIDATES_PER_SLOT)
        .select(F.pmod(F.hash("id"), F.lit(slots)).alias("_slot"), "id")
        .groupBy("_slot")
        .agg(F.min("id").alias("_label"))
    )
    fallback = F.col("_slot").cast("bigint") + F.lit(slots * LABEL_CANDIDATES_PER_SLOT)
    return (
        spark.range(0, slots)
        .select(F.col("id").cast("int").alias("_slot"))
        .join(found, "_slot", "left")
        .select("_slot", F.coalesce(F.col("_label"), fallback).alias("_label"))
    )


def broadcast_split_pairs(pts: DataFrame, keys: list[str], plan: PairWorkload, condition=lex_less, packed: bool = False):
    """Pairs of split groups whose points fit a broadcast: only anchors are dealt out.

    Anchors are hash-partitioned by (group, anchor) over one task per pair
    budget, so n rows move; every anchor meets the broadcast points of its
    group.  Without groups the join key is a column that is 0 in every row.
    """
    extra = _condition(condition, packed)
    zero = F.shiftright(F.hash("x", "y").cast("bigint").bitwiseAND(F.lit(0x7FFFFFFF)), 31)
    by = [F.col(k) for k in keys] or [zero.alias("_zero")]
    names = keys or ["_zero"]
    anchor_names = list(_names(packed, True))
    anchors = pts.select(*by, *_anchor_cols(packed)).repartition(max(plan.partitions, 1), *keys, *anchor_names)
    # size-checked: the measured bytes of the hot groups' points are within the bound
    partners = F.broadcast(pts.select(*[c.alias(n + "_b") for c, n in zip(by, names)], *_partner_cols(packed)))
    eq = [F.col(n) == F.col(n + "_b") for n in names]
    return _pair_join(anchors, partners, eq, extra), list(keys) + anchor_names


def split_pairs(tagged: DataFrame, keys: list[str], plan: PairWorkload, condition=lex_less, packed: bool = False):
    """Pairs of the groups that one task cannot take."""
    if plan.split_broadcast:
        return broadcast_split_pairs(tagged, keys, plan, condition, packed)
    return salted_pairs(tagged, keys, plan, condition, packed)


def salted_pairs(tagged: DataFrame, keys: list[str], plan: PairWorkload, condition=lex_less, packed: bool = False):
    """Pairs where each group's anchors are split into ``_s`` buckets.

    ``tagged`` carries ``_s`` (buckets of the group) and ``_off`` (first global
    slot of the group); bucket slots are numbered globally so that one label
    column identifies (group, bucket).  Anchors go to one bucket by a hash of
    the point; every bucket gets a copy of all of its group's points.  The join
    key is the label alone, co-partitioned on both sides.
    """
    extra = _condition(condition, packed)
    slots = plan.salt_slots
    slot = (F.col("_off") + F.pmod(F.xxhash64("x", "y"), F.col("_s").cast("bigint"))).cast("int")
    part_slots = F.explode(F.sequence(F.col("_off"), F.col("_off") + F.col("_s") - F.lit(1))).alias("_slot")
    anchors = tagged.select(*keys, slot.alias("_slot"), *_anchor_cols(packed))
    partners = tagged.select(part_slots, *_partner_cols(packed))
    if slots > 1:
        labels = F.broadcast(bucket_labels(tagged.sparkSession, slots))  # `slots` rows, < 2 * partitions
        anchors, partners = anchors.join(labels, "_slot", "left"), partners.join(labels, "_slot", "left")
        # a slot without a label (none expected) still gets a unique one: balance, not results, would suffer
        label = F.coalesce(F.col("_label"), F.col("_slot").cast("bigint") + F.lit(slots * LABEL_CANDIDATES_PER_SLOT))
    else:
        label = F.col("_slot").cast("bigint")
    anchors = anchors.select(*keys, label.alias("_bucket"), *_names(packed, True)).repartition(slots, "_bucket")
    partners = partners.select(label.alias("_bucket_b"), *_names(packed, False)).repartition(slots, "_bucket_b").hint("merge")
    eq = [F.col("_bucket") == F.col("_bucket_b")]
    return _pair_join(anchors, partners, eq, extra), list(keys) + ["_bucket"]


def _names(packed: bool, anchor: bool) -> tuple[str, ...]:
    if packed:
        return ("_a",) if anchor else ("_b",)
    return ("ax", "ay") if anchor else ("bx", "by_")


def split_hot(prep: Prepared) -> tuple[DataFrame | None, DataFrame | None]:
    """(co-located points, salted points with ``_s`` and ``_off``); either may be None."""
    plan, keys = prep.plan, prep.keys
    if not keys:
        return None, prep.pts.withColumn("_s", F.lit(plan.global_buckets)).withColumn("_off", F.lit(0))
    if plan.hot_groups == 0:
        return prep.pts, None
    hot = hot_group_buckets(prep.sizes, keys, plan)  # < plan.partitions rows
    # first global slot of each hot group: a running sum over that small table
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    hot = F.broadcast(hot.withColumn("_off", F.coalesce(F.sum("_s").over(before), F.lit(0)).cast("int")))
    cold = prep.pts.join(hot.select(*keys), on=keys, how="left_anti")
    return cold, prep.pts.join(hot, on=keys, how="inner")


# ---- steps 3-5: candidates and lines ------------------------------------------------------


def _small(plan: PairWorkload) -> bool:
    return plan.max_abs < SMALL_COORD_BOUND


def anchor_directions(joined: DataFrame, part_cols: list[str], small: bool):
    """Per (anchor, direction): partner count and the nearest / farthest partner.

    Groups by the join's partitioning columns plus the direction, so Spark plans
    the aggregate inside the join's stage.  Returns (candidates, direction cols).
    """
    dx = F.col("bx") - F.col("ax")
    dy = F.col("by_") - F.col("ay")
    if small:
        slope_key = F.when(dx == 0, F.lit(INFINITY)).otherwise(dy.cast("double") / dx.cast("double") + F.lit(0.0))
        keyed = joined.select(*part_cols, "ax", "ay", "bx", "by_", slope_key.alias("_slope"))
        dir_cols = ["_slope"]
        desc = F.col("_slope") < 0
    else:
        diffs = joined.select(*part_cols, "ax", "ay", "bx", "by_", dx.alias("_dx"), dy.alias("_dy"))
        diffs = diffs.withColumn("_div", direction_divisor("_dx", "_dy"))
        slope_key, ex_ux, ex_uy = direction_key("_dx", "_dy", "_div")
        keyed = diffs.select(
            *part_cols, "ax", "ay", "bx", "by_", slope_key.alias("_slope"), ex_ux.alias("_ex_ux"),
            ex_uy.alias("_ex_uy"), (F.col("_dy") < 0).alias("_desc"),
        )
        dir_cols = ["_slope", "_ex_ux", "_ex_uy", "_desc"]
        desc = F.col("_desc")
    group = list(dict.fromkeys(part_cols + ["ax", "ay"]))
    agg = (
        keyed.groupBy(*group, *dir_cols)
        .agg(
            F.count(F.lit(1)).alias("_cnt"),
            F.min("bx").alias("_min_bx"),
            F.max("bx").alias("_max_bx"),
            F.min("by_").alias("_min_by"),
            F.max("by_").alias("_max_by"),
        )
        .where(F.col("_cnt") >= F.lit(2))
    )
    out_dirs = [c for c in dir_cols if c != "_desc"]
    cand = agg.select(
        *[c for c in group if c != "_bucket"],
        *out_dirs,
        "_cnt",
        F.col("_min_bx").alias("_nx"),
        F.when(desc, F.col("_max_by")).otherwise(F.col("_min_by")).alias("_ny"),
        F.col("_max_bx").alias("_lx"),
        F.when(desc, F.col("_min_by")).otherwise(F.col("_max_by")).alias("_ly"),
    )
    return cand, out_dirs


def _pt(x: str, y: str) -> Column:
    return F.struct(F.col(x).alias("x"), F.col(y).alias("y"))


def anchor_directions_packed(joined: DataFrame, part_cols: list[str]):
    """:func:`anchor_directions` on packed points (small coordinates only).

    Key (join partitioning, packed anchor, slope); min / max of the packed
    partner are the nearest / farthest partner on the ray.
    """
    a, b = F.col("_a"), F.col("_b")
    dx = unpack_x(b) - unpack_x(a)
    dy = unpack_y(b) - unpack_y(a)
    slope_key = F.when(dx == 0, F.lit(INFINITY)).otherwise(dy.cast("double") / dx.cast("double") + F.lit(0.0))
    group = list(dict.fromkeys(part_cols + ["_a"]))
    agg = (
        joined.select(*group, "_b", slope_key.alias("_slope"))
        .groupBy(*group, "_slope")
        .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_b").alias("_nb"), F.max("_b").alias("_lb"))
        .where(F.col("_cnt") >= F.lit(2))
    )
    cand = agg.select(
        *[c for c in group if c not in ("_bucket", "_a")],
        unpack_x(a).alias("ax"),
        unpack_y(a).alias("ay"),
        "_slope",
        "_cnt",
        unpack_x(F.col("_nb")).alias("_nx"),
        unpack_y(F.col("_nb")).alias("_ny"),
        unpack_x(F.col("_lb")).alias("_lx"),
        unpack_y(F.col("_lb")).alias("_ly"),
    )
    return cand, ["_slope"]


def assemble_lines(
    cand: DataFrame, keys: list[str], dir_cols: list[str], max_abs: int, min_points: int = 3
) -> DataFrame:
    """Gather each line's candidates (same group, direction and farthest point).

    ``sort_array`` (generated code) orders the points; ``array_sort`` would run
    an interpreted comparator per comparison.
    """
    lines = (
        cand.groupBy(*keys, *dir_cols, "_lx", "_ly")
        .agg(
            (F.max("_cnt") + F.lit(1)).alias("n_points"),
            F.collect_list(_pt("ax", "ay")).alias("_anchors"),
            F.min_by(_pt("_nx", "_ny"), F.col("_cnt")).alias("_pen"),
        )
        .where(F.col("n_points") >= F.lit(min_points))
    )
    points = F.sort_array(F.concat(F.col("_anchors"), F.array(F.col("_pen"), _pt("_lx", "_ly"))))
    lines = lines.select(
        *keys,
        "n_points",
        points.alias("points"),
        "_lx",
        "_ly",
        (F.col("_lx") - F.col("_pen")["x"]).alias("_ddx"),
        (F.col("_ly") - F.col("_pen")["y"]).alias("_ddy"),
    )
    # primitive direction from the last two points (never zero: they differ)
    lines = lines.withColumn("_d", gcd_bounded(F.col("_ddx"), F.abs(F.col("_ddy")), 2 * max_abs))
    lines = lines.select(
        *keys, int_div("_ddx", "_d").alias("ux"), int_div("_ddy", "_d").alias("uy"), "_lx", "_ly", "n_points", "points"
    )
    wide = lambda name: F.col(name).cast("decimal(19,0)")
    # DECIMAL(38,0): a product of two BIGINTs does not fit BIGINT
    c = (wide("ux") * wide("_ly") - wide("uy") * wide("_lx")).cast("decimal(38,0)")
    return lines.select(*keys, "ux", "uy", c.alias("c"), "n_points", "points")


def candidates_of(prep: Prepared) -> list[tuple[DataFrame, list[str], bool]]:
    """(candidates, their direction columns, whether a line's candidates are in several tasks) by layout.

    A candidate is an anchor with two or more partners in one direction; see
    the module's steps 3 and 4 for how the points of a line follow from them.
    """
    small = _small(prep.plan)
    cold, hot = split_hot(prep)
    parts = []
    if cold is not None:
        joined, part_cols = colocated_pairs(cold, prep.keys, prep.plan, packed=small)
        parts.append((*_candidates(joined, part_cols, small), False))
    if hot is not None:
        parts.append((*_hot_candidates(hot, prep), True))
    return parts


def _candidates(joined: DataFrame, part_cols: list[str], small: bool):
    if small:
        return anchor_directions_packed(joined, part_cols)
    return anchor_directions(joined, part_cols, small)


def _hot_candidates(hot: DataFrame, prep: Prepared):
    small = _small(prep.plan)
    joined, part_cols = split_pairs(hot, prep.keys, prep.plan, packed=small)
    return _candidates(joined, part_cols, small)


def point_rows(prep: Prepared, marks: list[str] | None = None) -> tuple[list[DataFrame], DataFrame | None]:
    """(rows of whole groups for :func:`colline.operators.rays.array_lines`, points of groups too large for a row).

    Hot groups are rows while their measured points fit the broadcast bound.
    """
    plan, keys = prep.plan, prep.keys
    cold, hot = split_hot(prep)
    rows = [] if cold is None else [rows_by_group(cold, keys, plan.partitions, plan.broadcast, marks)]
    if hot is not None and (plan.split_broadcast or not plan.hot_groups):
        rows.append(rows_by_share(hot, keys, plan.salt_slots, marks))
        hot = None
    return rows, hot


def line_constant(lines: DataFrame, max_abs: int) -> Column:
    """c of rows with ``ux, uy, points``: BIGINT arithmetic where it fits, else DECIMAL."""
    first = F.element_at("points", 1)
    if max_abs < SMALL_COORD_BOUND:
        return (F.col("ux") * first["y"] - F.col("uy") * first["x"]).cast("decimal(38,0)")
    wide = lambda c: c.cast("decimal(19,0)")
    return (wide(F.col("ux")) * wide(first["y"]) - wide(F.col("uy")) * wide(first["x"])).cast("decimal(38,0)")


def row_lines(rows: DataFrame, prep: Prepared, min_points: int = 3, share: int = 0) -> DataFrame:
    """Lines of :func:`point_rows`, in the columns of :func:`assemble_lines`."""
    found = array_lines(rows, prep.keys, _small(prep.plan), min_points, share)
    return found.select(
        *prep.keys, "ux", "uy", line_constant(found, prep.plan.max_abs).alias("c"), F.size("points").cast("bigint").alias("n_points"), "points"
    )


def swept(prep: Prepared, min_points: int, pairs: int, text: bool = False) -> DataFrame | None:
    """The lines of points that are one dense set (:mod:`colline.operators.sweep`), else None.

    ``pairs`` are what the search would form otherwise.
    """
    plan = prep.plan
    in_a_row = plan.split_broadcast or not plan.hot_groups
    if prep.keys or not in_a_row or not _small(plan) or not sweeps(prep.pts.sparkSession, plan, min_points, pairs):
        return None
    return sweep_lines(prep.pts, plan, min_points, text)


def lines_of(prep: Prepared, min_points: int = 3, text: bool = False) -> DataFrame:
    """Lines of prepared points (internal key columns kept)."""
    out = swept(prep, min_points, prep.plan.n_points**2, text)
    if out is not None:
        return out
    out = _paired_lines(prep, min_points)
    return out.withColumn("points", points_text("points")) if text else out


def _paired_lines(prep: Prepared, min_points: int) -> DataFrame:
    rows, rest = point_rows(prep)
    parts = [row_lines(r, prep, min_points) for r in rows]
    if rest is not None:
        # a line's candidates come from several buckets: shuffle them by line
        # directly (a map-side partial aggregate would rarely combine anything)
        cand, dir_cols = _hot_candidates(rest, prep)
        cand = cand.repartition(*prep.keys, *dir_cols, "_lx", "_ly")
        parts.append(assemble_lines(cand, prep.keys, dir_cols, prep.plan.max_abs, min_points))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def collinear_sets(
    points: DataFrame,
    group_cols: str | Sequence[str] | None = None,
    x: str = "x",
    y: str = "y",
    min_points: int = 3,
    *,
    mode: str = "strict",
    pairs_per_task: int | None = None,
    broadcast_max_bytes: int | None = None,
    materialize_points: bool = False,
    text: bool = False,
    return_plan: bool = False,
):
    """Every maximal set of ``min_points`` or more collinear points, one row per line.

    Output: group columns, ``ux, uy, c`` (exact line key: ux*y - uy*x = c on the
    line, gcd(ux, uy) = 1, ux > 0 or (ux, uy) = (0, 1)), ``n_points`` and
    ``points`` (``ARRAY<STRUCT<x,y>>`` sorted by x, then y).

    ``group_cols`` finds lines inside each group (an extension: the reference
    works on one set).  One sizing job runs while the plan is built; the result
    is lazy and nothing is written.  ``materialize_points`` writes the distinct
    points once to the checkpoint folder (if the session names one), so the
    sizing job and the main job do not both scan the source.  ``text`` gives the
    points as ``'x y;x y;...'``, made where the lines are found if that is cheaper.

    ``mode="strict"`` fails the job on a NULL, fractional or out-of-range
    coordinate; ``"permissive"`` returns ``(lines, rejects)``, the rejected
    input rows with all their columns.
    """
    if mode == "permissive":
        good, bad = split_points(points, x, y)
        out = collinear_sets(
            good, group_cols, x, y, min_points, pairs_per_task=pairs_per_task,
            broadcast_max_bytes=broadcast_max_bytes, materialize_points=materialize_points, text=text, return_plan=return_plan,
        )
        return (out[0], bad, out[1]) if return_plan else (out, bad)
    if min_points < 3:
        raise ValueError("min_points must be at least 3 (any two points share a line)")
    prep = prepare(
        points, group_cols, x, y,
        pairs_per_task=pairs_per_task,
        broadcast_max_bytes=broadcast_max_bytes,
        materialize_points=materialize_points,
    )
    out = restore_groups(lines_of(prep, min_points, text), prep)
    return (out, prep.plan) if return_plan else out


def line_params(lines: DataFrame) -> DataFrame:
    """Add the reference's described parameters: ``is_vertical, slope, intercept``.

    Non-vertical: y = slope*x + intercept with slope = uy/ux, intercept = c/ux.
    Vertical: slope = +Infinity and intercept is the x of the line, as the
    reference defines it.  Both are correctly rounded quotients of exact
    integers, never ``y - slope*x``, which splits lines by rounding.
    """
    vertical = F.col("ux") == 0
    slope = F.when(vertical, F.lit(INFINITY)).otherwise(
        F.col("uy").cast("double") / F.col("ux").cast("double") + F.lit(0.0)
    )
    intercept = F.when(vertical, (-F.col("c")).cast("double") + F.lit(0.0)).otherwise(
        F.col("c").cast("double") / F.col("ux").cast("double") + F.lit(0.0)
    )
    return lines.withColumn("is_vertical", vertical).withColumn("slope", slope).withColumn("intercept", intercept)
