"""colline: maximal collinear point sets as Spark DataFrame plans."""

from colline.operators.anchors import anchor_groups, collinear_sets_by_anchor, format_groups, group_pairs
from colline.operators.compare import same_sets, set_difference_counts, set_differences
from colline.operators.incidence import extend_lines, line_sets, lines_through, points_on_lines, rich_lines
from colline.operators.lines import collinear_sets, line_params
from colline.operators.members import line_members, page_points, paged_lines
from colline.operators.pairs import cartesian, half_pairs, ordered_pairs, with_slope
from colline.plans.process import build_collinear_set, process
from colline.operators.wide import parse_wide_points, wide_collinear_sets, wide_points
from colline.sources.sink import read_batches, read_manifest, write_batch
from colline.sources.text import parse_points, points_from, read_points, write_sets

__all__ = [
    "anchor_groups",
    "build_collinear_set",
    "cartesian",
    "collinear_sets",
    "collinear_sets_by_anchor",
    "extend_lines",
    "format_groups",
    "group_pairs",
    "half_pairs",
    "line_members",
    "line_params",
    "line_sets",
    "lines_through",
    "ordered_pairs",
    "page_points",
    "paged_lines",
    "parse_points",
    "parse_wide_points",
    "points_from",
    "points_on_lines",
    "process",
    "read_batches",
    "read_manifest",
    "read_points",
    "rich_lines",
    "same_sets",
    "set_difference_counts",
    "set_differences",
    "wide_collinear_sets",
    "wide_points",
    "with_slope",
    "write_batch",
    "write_sets",
]
