"""The reference's step-by-step operators: pairs, slopes, by-anchor groups, verifier
(J1, J2, F1, A2, P2, A1, A4, P3-P7, T1, T2, Q1-Q4)."""

from __future__ import annotations

from pyspark.sql import functions as F
import pytest

from colline.operators.anchors import anchor_groups, collinear_sets_by_anchor, format_groups, group_pairs
from colline.operators.compare import same_sets, set_difference_counts
from colline.operators.lines import collinear_sets
from colline.operators.pairs import cartesian, half_pairs, ordered_pairs, with_slope

from .conftest import GOLDEN8, GOLDEN9, POINTS8, POINTS9, POINTS40, points_df


def _pairs(df):
    return sorted(((r["ax"], r["ay"]), (r["bx"], r["by_"])) for r in df.collect())


def test_ordered_pairs_f5(spark):
    got = _pairs(ordered_pairs(points_df(spark, [(1, 0), (2, 0), (3, 0)]), ()))
    assert got == [
        ((1, 0), (2, 0)), ((1, 0), (3, 0)), ((2, 0), (1, 0)),
        ((2, 0), (3, 0)), ((3, 0), (1, 0)), ((3, 0), (2, 0)),
    ]


def test_ordered_pairs_counts(spark):
    assert ordered_pairs(points_df(spark, POINTS40), ()).count() == 1560
    assert ordered_pairs(points_df(spark, POINTS9 + POINTS9), ()).count() == 72  # distinct first (Q2)
    assert half_pairs(points_df(spark, POINTS9), ()).count() == 36


def test_cartesian_keeps_self_pairs_and_duplicates(spark):
    assert cartesian(points_df(spark, [(1, 0), (2, 0), (3, 0)]), ()).count() == 9
    assert cartesian(points_df(spark, [(1, 0), (1, 0)]), ()).count() == 4


def test_pairs_per_group_and_salted(spark):
    rows = [(g, x, y) for g in (1, 2) for x, y in POINTS9]
    df = spark.createDataFrame(rows, "g int, x long, y long")
    plain = ordered_pairs(df, "g")
    salted = ordered_pairs(df, "g", pairs_per_task=5)
    assert plain.count() == salted.count() == 144
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))


def test_with_slope_f6(spark):
    df = spark.createDataFrame(
        [(1, 2, -7, -2), (1, 2, 3, 4), (1, 2, 1, 5), (1, 2, 2, 5), (1, 2, 1, 2)],
        "ax long, ay long, bx long, by_ long",
    )
    got = [(r["is_vertical"], r["slope"]) for r in with_slope(df).collect()]
    assert got == [(False, 0.5), (False, 1.0), (True, float("inf")), (False, 3.0), (False, None)]


def test_anchor_groups_pairs12_f4(spark):
    pts = [(4, 2), (2, 1), (-3, 4), (6, 3)]
    rows = anchor_groups(points_df(spark, pts)).collect()
    # the line (2,1) (4,2) (6,3) once per anchor, anchor first
    assert sorted(tuple((p["x"], p["y"]) for p in r["points"]) for r in rows) == [
        ((2, 1), (4, 2), (6, 3)),
        ((4, 2), (2, 1), (6, 3)),
        ((6, 3), (2, 1), (4, 2)),
    ]
    assert all(r["slope"] == 0.5 for r in rows)


def _pairs12():
    # Fixed value: all ordered pairs of the four points of F-4.
    pts = [(4, 2), (2, 1), (-3, 4), (6, 3)]
    return [(*a, *b) for a in pts for b in pts if a != b]


def _group_sets(spark, rows, schema="ax long, ay long, bx long, by_ long"):
    out = group_pairs(spark.createDataFrame(rows, schema)).collect()
    return sorted(tuple((p["x"], p["y"]) for p in r["points"]) for r in out)


def test_group_pairs_f4(spark):
    assert _group_sets(spark, _pairs12()) == [((2, 1), (4, 2), (6, 3)), ((4, 2), (2, 1), (6, 3)), ((6, 3), (2, 1), (4, 2))]


def test_group_pairs_repeated_pair_loses_its_group_q3(spark):
    rows = _pairs12() + [(2, 1, 4, 2)]
    assert _group_sets(spark, rows) == [((4, 2), (2, 1), (6, 3)), ((6, 3), (2, 1), (4, 2))]


def test_group_pairs_edges(spark):
    assert _group_sets(spark, [], "ax long, ay long, bx long, by_ long") == []
    assert _group_sets(spark, [(1, 1, 1, 1), (1, 1, 2, 2)]) == []  # a self pair has no slope
    a = 2**27  # two directions with one rounded slope
    assert _group_sets(spark, [(0, 0, a, a + 1), (0, 0, a + 1, a + 2)]) == []
    with pytest.raises(Exception, match="NULL coordinate"):
        group_pairs(spark.createDataFrame([(1, 1, None, 2)], "ax long, ay long, bx long, by_ long")).count()


def test_two_ways_to_the_sets_and_a_damaged_side(spark):
    pts = points_df(spark, POINTS40)
    left = group_pairs(ordered_pairs(pts, ())).withColumn("points", F.sort_array("points"))
    right = collinear_sets(pts)
    assert same_sets(left, right)
    damaged = right.where("ux = 1 and uy = 0")
    row = set_difference_counts(left, damaged).first()
    assert (row["n_left"], row["n_right"], row["n_only_left"], row["n_only_right"]) == (65, 9, 56, 0)
    row = set_difference_counts(left.where("not is_vertical"), right).first()
    assert row["n_only_right"] == 9


def test_pairs_need_group_columns(spark):
    with pytest.raises(TypeError):
        ordered_pairs(points_df(spark, POINTS9))


def test_format_groups_anchor_last(spark):
    rows = format_groups(anchor_groups(points_df(spark, [(4, 2), (2, 1), (6, 3)]))).collect()
    r = [r for r in rows if (r["ax"], r["ay"]) == (2, 1)][0]
    assert [(p["x"], p["y"]) for p in r["points"]] == [(4, 2), (6, 3), (2, 1)]


def test_sets_by_anchor_counts_q1(spark):
    assert collinear_sets_by_anchor(points_df(spark, POINTS9)).count() == 10
    assert collinear_sets_by_anchor(points_df(spark, POINTS40)).count() == 237


def test_anchor_groups_vertical_slope(spark):
    rows = anchor_groups(points_df(spark, POINTS8)).collect()
    vertical = [r for r in rows if r["is_vertical"]]
    assert len(vertical) == 3 and all(r["slope"] == float("inf") for r in vertical)


def test_same_sets_t1(spark):
    a = collinear_sets_by_anchor(points_df(spark, POINTS9))
    b = collinear_sets(points_df(spark, POINTS9))
    assert same_sets(a, b)
    assert not same_sets(a, collinear_sets(points_df(spark, POINTS8)))
    row = set_difference_counts(a, collinear_sets(points_df(spark, POINTS8))).first()
    assert (row["n_left"], row["n_right"]) == (len(GOLDEN9), len(GOLDEN8))
    assert row["n_only_left"] == 3 and row["n_only_right"] == 2  # no common set
