"""Lines as rows: one row per point of a line, and pages of bounded size.

A line of the result of :func:`colline.collinear_sets` is one row with an array
of its points, so a line with a third of all points is one huge row in one
task.  Here a line's points leave the search as rows of their own, and
:func:`page_points` packs them into pages: the rows are range-partitioned by
(line, x, y), so a long line spreads over many tasks; a point's rank in its
line is its place in its range plus the sizes of the line's earlier ranges, and
the page is cut by that rank.  No array and no task holds a line.  Lines of groups
that one task can take are bounded and cut where they are found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colline.functions.geometry import gcd_bounded, int_div
from colline.operators.lines import Prepared, _as_list, _hot_candidates, candidates_of, prepare, restore_groups, row_lines, split_hot
from colline.operators.rays import rows_by_group, rows_by_share
from colline.sources.storage import materialize_always
from colline.sources.text import ref

LINE = ["ux", "uy", "c"]
PAGE_POINTS = 10_000


def line_members(
    points: DataFrame, group_cols: str | Sequence[str] | None = None, x: str = "x", y: str = "y", **sizing
) -> DataFrame:
    """Every point of every line of three or more points: rows ``group columns, ux, uy, c, x, y``.

    Each candidate of the search gives its anchor; the one with two partners
    also gives these, the last two points of the line (see
    :mod:`colline.operators.lines`).  Nothing is collected per line.
    """
    prep = prepare(points, group_cols, x, y, **sizing)
    return restore_groups(_members(prep, [cand for cand, _, _ in candidates_of(prep)]), prep)


def _members(prep: Prepared, candidates: list[DataFrame]) -> DataFrame:
    out = None
    for cand in candidates:
        rows = cand.select(
            *prep.keys, "ax", "ay", "_cnt", "_nx", "_ny", "_lx", "_ly", (F.col("_lx") - F.col("ax")).alias("_dx"), (F.col("_ly") - F.col("ay")).alias("_dy")
        )
        rows = rows.withColumn("_d", gcd_bounded(F.col("_dx"), F.abs(F.col("_dy")), 2 * max(prep.plan.max_abs, 1)))
        rows = rows.withColumn("ux", int_div("_dx", "_d")).withColumn("uy", int_div("_dy", "_d"))
        wide = lambda name: F.col(name).cast("decimal(19,0)")
        c = (wide("ux") * wide("_ly") - wide("uy") * wide("_lx")).cast("decimal(38,0)")
        anchor, near, last = (F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a, b in (("ax", "ay"), ("_nx", "_ny"), ("_lx", "_ly")))
        own = F.when(F.col("_cnt") == 2, F.array(anchor, near, last)).otherwise(F.array(anchor))
        part = rows.select(*prep.keys, "ux", "uy", c.alias("c"), F.explode(own).alias("_p"))
        part = part.select(*prep.keys, *LINE, F.col("_p.x").alias("x"), F.col("_p.y").alias("y"))
        out = part if out is None else out.unionByName(part)
    return out


def page_points(
    members: DataFrame, group_cols: str | Sequence[str] | None = None, page_size: int = PAGE_POINTS, min_points: int = 1
) -> DataFrame:
    """``group columns, ux, uy, c, n_points, page, points``: a line's points in pages, sorted by x, then y.

    ``members`` has distinct rows ``group columns, ux, uy, c, x, y``
    (:func:`line_members`, :func:`colline.operators.incidence.points_on_lines`).
    Pages count from 0 and all but a line's last have ``page_size`` points.
    The ranges are written to the checkpoint folder once, so a lost executor
    cannot deal them out differently.
    """
    if page_size < 1:
        raise ValueError("a page has at least one point")
    gcols = _as_list(group_cols)
    names = [f"_k{i}" for i in range(len(gcols))]
    line = [*names, *LINE]
    rows = members.select(*[ref(c).alias(k) for c, k in zip(gcols, names)], *LINE, "x", "y")
    rows = rows.repartitionByRange(*line, "x", "y")
    rows = materialize_always(rows.withColumn("_range", F.spark_partition_id()), "line-ranges")
    sizes = rows.groupBy(*line, "_range").agg(F.count(F.lit(1)).alias("_n"))
    # a line's ranges: as many as tasks share it
    before = Window.partitionBy(*line).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        *line, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*line)).alias("n_points"),
    ).where(F.col("n_points") >= min_points)
    sizes = sizes.select(*[F.col(c).alias(c + "_s") for c in [*line, "_range"]], "_before", "n_points")
    same = rows["_range"] == sizes["_range_s"]
    for k in line:
        same = same & rows[k].eqNullSafe(sizes[k + "_s"])
    place = F.row_number().over(Window.partitionBy(*line, "_range").orderBy("x", "y"))
    ranked = rows.join(sizes, same).select(*line, "n_points", "x", "y", (F.col("_before") + place - 1).alias("_rank"))
    page = F.call_function("div", F.col("_rank"), F.lit(page_size).cast("bigint")).alias("page")
    pages = ranked.select(*line, "n_points", page, "x", "y").groupBy(*line, "n_points", "page").agg(
        F.sort_array(F.collect_list(F.struct("x", "y"))).alias("points")
    )
    return pages.select(*[F.col(k).alias(c) for k, c in zip(names, gcols)], *LINE, "n_points", "page", "points")


def paged_lines(
    points: DataFrame, group_cols: str | Sequence[str] | None = None, x: str = "x", y: str = "y", min_points: int = 3,
    page_size: int = PAGE_POINTS, **sizing,
) -> DataFrame:
    """:func:`colline.collinear_sets` in pages: ``group columns, ux, uy, c, n_points, page, points``.

    Lines of groups that one task can take (a bounded number of points) are cut
    where they are found; only those of larger groups go through :func:`page_points`.
    """
    if page_size < 1:
        raise ValueError("a page has at least one point")
    prep = prepare(points, group_cols, x, y, **sizing)
    plan = prep.plan
    cold, hot = split_hot(prep)
    rows = None if cold is None else rows_by_group(cold, prep.keys, plan.partitions, plan.broadcast)
    if hot is not None and not plan.hot_groups:
        rows, hot = rows_by_share(hot, prep.keys, 1), None
    parts = []
    if rows is not None:
        parts.append(cut_pages(restore_groups(row_lines(rows, prep, min_points), prep), page_size))
    if hot is not None:
        members = restore_groups(_members(prep, [_hot_candidates(hot, prep)[0]]), prep)
        parts.append(page_points(members, group_cols, page_size, min_points))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def cut_pages(lines: DataFrame, page_size: int) -> DataFrame:
    """The pages of lines with a sorted array ``points`` each; other columns are repeated."""
    size = F.lit(page_size)
    last = F.call_function("div", F.size("points") - F.lit(1), size).cast("int")
    page = F.when(last == 0, F.array(F.col("points"))).otherwise(
        F.transform(F.sequence(F.lit(0), last), lambda k: F.slice("points", k * size + F.lit(1), size))
    )
    rest = [ref(c) for c in lines.columns if c != "points"]
    out = lines.select(*rest, F.posexplode(page).alias("page", "points"))
    return out.withColumn("page", F.col("page").cast("bigint"))
