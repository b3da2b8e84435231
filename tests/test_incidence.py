"""Points on given lines, lines of many points, lines after points were added: against a brute force."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from colline import collinear_sets, extend_lines, line_sets, lines_through, points_on_lines, rich_lines
from colline.operators import incidence as I
from colline.operators.lines import distinct_points

from .conftest import POINTS40, as_sets, brute_force_lines, points_df

BIG = 1 << 60


def _grid(rnd, n, size=9):
    return [(rnd.randrange(size), rnd.randrange(size)) for _ in range(n)]


def _rows(df):
    return sorted((tuple(tuple(map(tuple, v)) if isinstance(v, list) else v for v in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bound", [None, 0])
@pytest.mark.parametrize("scale", [1, BIG // 10])
def test_lookup_finds_every_point_of_given_pairs(spark, bound, scale):
    pts = [(x * scale, y * scale + 1) for x, y in POINTS40]
    rnd = random.Random(1)
    pairs = [(*a, *b) for a, b in rnd.sample(list(combinations(pts, 2)), 40)] + [(*pts[0], *pts[0])]
    lines = lines_through(spark.createDataFrame(pairs + pairs[:3], "ax long, ay long, bx long, by_ long"))
    members = points_on_lines(points_df(spark, pts + pts[:4]), lines, broadcast_max_bytes=bound)
    want = set()
    for ax, ay, bx, by in pairs[:-1]:
        want.add(tuple(sorted((x, y) for x, y in pts if (bx - ax) * (y - ay) == (by - ay) * (x - ax))))
    assert as_sets(line_sets(members)) == want
    assert lines.count() == len(want)


@pytest.mark.parametrize("bound", [None, 0])
def test_lookup_keeps_groups_apart_with_null_groups_and_any_names(spark, bound):
    rnd = random.Random(2)
    rows = [(g, *p) for g in ("a", "b", None) for p in _grid(rnd, 12, 5)]
    df = spark.createDataFrame(rows, "`g.h` string, x long, y long")
    lines = collinear_sets(df, "g.h")
    members = points_on_lines(df, lines, "g.h", broadcast_max_bytes=bound)
    assert members.columns == ["g.h", "ux", "uy", "c", "x", "y"]
    assert _rows(line_sets(members.withColumnRenamed("g.h", "g"), "g")) == _rows(lines)


def test_lookup_plan_has_no_product_and_no_pairs(spark):
    df = points_df(spark, POINTS40)
    for bound in (None, 0):
        plan = points_on_lines(df, collinear_sets(df), broadcast_max_bytes=bound)._jdf.queryExecution().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_points_and_lines_of_small_groups_move_once_each(spark):
    """every point with every direction of its group was shuffled to the lines."""
    df = spark.createDataFrame([(g, x, y) for g in range(5) for x, y in POINTS40], "g int, x long, y long")
    members = points_on_lines(df, collinear_sets(df, "g"), "g", broadcast_max_bytes=0)
    moved = [line for line in members._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
    assert moved and not any("ux" in line for line in moved)


@pytest.mark.parametrize("bound", [None, 0])
@pytest.mark.parametrize("scale", [1, BIG // 10])
def test_lookup_by_lines_equals_lookup_by_directions(spark, monkeypatch, bound, scale):
    rnd = random.Random(3)
    rows = [(g, x * scale, y * scale) for g, n in ((1, 30), (2, 3), (None, 12)) for x, y in _grid(rnd, n, 6)]
    df = spark.createDataFrame(rows, "g int, x long, y long")
    lines = collinear_sets(df.where(f"x <= {4 * scale}"), "g")
    by_lines = _rows(points_on_lines(df, lines, "g", broadcast_max_bytes=bound))
    assert by_lines
    for limit in ("TESTS_PER_ROW", "TESTS_PER_GROUP"):
        with monkeypatch.context() as m:
            m.setattr(I, limit, 0)
            out = points_on_lines(df, lines, "g", broadcast_max_bytes=bound)
            assert "c_l" in out._jdf.queryExecution().toString()
            assert _rows(out) == by_lines


def test_lookup_of_empty_tables(spark):
    df = points_df(spark, POINTS40)
    assert points_on_lines(df, collinear_sets(df.where("x > 99"))).count() == 0
    assert points_on_lines(df.where("x > 99"), collinear_sets(df)).count() == 0


@pytest.mark.parametrize("k", [3, 4, 5, 6, 7])
def test_rich_lines_equal_the_full_search(spark, k):
    rnd = random.Random(k)
    pts = _grid(rnd, 45, 10) + [(i, 3 * i - 7) for i in range(8)] + [(100, i * i) for i in range(6)]
    assert as_sets(rich_lines(points_df(spark, pts), k)) == brute_force_lines(pts, k)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7)), min_size=0, max_size=40), st.integers(5, 8), st.sampled_from([1, BIG // 8]))
def test_rich_lines_property(spark, pts, k, scale):
    pts = [(x * scale, y * scale) for x, y in pts]
    assert as_sets(rich_lines(points_df(spark, pts), k)) == brute_force_lines(pts, k)


def test_pigeonhole_leaves_three_points_in_a_bucket():
    for k in range(3, 200):
        m, s = I.pigeonhole(k)
        assert s >= 3 and (s - 1) * m < k and (m > 1 or k < 5)


@pytest.mark.parametrize("bound", [None, 0])
@pytest.mark.parametrize("scale", [1, BIG // 9])
def test_extended_lines_equal_the_full_search(spark, bound, scale):
    rnd = random.Random(7)
    pts = [(g, x * scale, y * scale) for g in (1, 2, None) for x, y in _grid(rnd, 14, 6)]
    old = spark.createDataFrame(pts[::2], "g int, x long, y long")
    new = spark.createDataFrame(pts[1::2] + pts[:4], "g int, x long, y long")
    got = extend_lines(collinear_sets(old, "g"), old, new, "g", broadcast_max_bytes=bound)
    assert got.columns == collinear_sets(old, "g").columns
    assert _rows(got) == _rows(collinear_sets(old.unionAll(new), "g"))


def test_extending_from_nothing_by_nothing_and_with_more_points_a_line(spark):
    df = points_df(spark, POINTS40)
    none = df.where("x > 99")
    assert as_sets(extend_lines(collinear_sets(none), none, df)) == brute_force_lines(POINTS40)
    assert as_sets(extend_lines(collinear_sets(df), df, none)) == brute_force_lines(POINTS40)
    old, new = df.where("x < 6"), df.where("x >= 6")
    assert as_sets(extend_lines(collinear_sets(old, min_points=4), old, new, min_points=4)) == brute_force_lines(POINTS40, 4)


def test_extension_forms_only_pairs_with_a_new_point(spark):
    pts = distinct_points(points_df(spark, POINTS40))
    new = pts.where("x = 7 or x = 8")
    n = new.count()
    assert I.delta_pairs(new, pts, []).count() == n * (len(POINTS40) - 1)
    assert I.delta_pairs(new, pts, [], bound=0).count() == n * (len(POINTS40) - 1)
