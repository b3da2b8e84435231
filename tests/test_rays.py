"""The pair stage on arrays: equal to brute force in every arithmetic, and nothing but points is shuffled."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest

from colline import collinear_sets, extend_lines, paged_lines, rich_lines
from colline.operators.compare import line_fingerprints
from colline.operators.wide import parse_wide_points, wide_collinear_sets
from tests.conftest import as_sets, brute_force_lines, points_df


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _random(n, seed, size=7):
    rnd = random.Random(seed)
    return sorted({(rnd.randrange(size), rnd.randrange(-size, size)) for _ in range(n)})


def _groups(spark, groups, pair=lambda p: p):
    rows = [(g, *pair(p)) for g, pts in groups.items() for p in pts]
    return spark.createDataFrame(rows, "g int, x long, y long")


def _shuffles(df):
    return [line for line in _plan(df).splitlines() if "Exchange" in line]


GROUPS = {1: _random(40, 1), 2: _random(9, 2), 3: [(0, 0), (1, 1)], None: _random(25, 3)}


@pytest.mark.parametrize("scale", [1, 2**27 + 1, 2**58 - 1])
def test_groups_of_different_sizes_in_every_arithmetic(spark, scale):
    df = _groups(spark, GROUPS, lambda p: (p[0] * scale, p[1] * scale))
    got = {(r["g"], tuple((p["x"] // scale, p["y"] // scale) for p in r["points"])) for r in collinear_sets(df, "g").collect()}
    assert got == {(g, s) for g, pts in GROUPS.items() for s in brute_force_lines(pts)}


def test_slopes_closer_than_rounding_are_told_apart(spark):
    n = 2**58
    pts = [(0, 0), (n, n + 1), (n + 1, n + 2), (-n, -n - 1), (n - 1, n)]
    assert as_sets(collinear_sets(points_df(spark, pts))) == brute_force_lines(pts)
    far = 10**30
    wide = [(x * far + (x > 1), y * far) for x, y in ((0, 0), (1, 1), (2, 2), (3, 3), (-1, -1), (5, 5), (-5, -5))]
    lines = wide_collinear_sets(parse_wide_points(spark.createDataFrame([(f"{x} {y}",) for x, y in wide], "value string")))
    assert as_sets(lines) == brute_force_lines(wide)
    assert all(r["ux"] * p["y"] - r["uy"] * p["x"] == r["c_hi"] * Decimal(10) ** 32 + r["c_lo"] for r in lines.collect() for p in r["points"][:1] if p["x"] == 0)


def test_a_large_group_shuffles_no_candidates(spark):
    """the lines of a split group were gathered by a shuffle of all candidates."""
    pts = _random(200, 5, 20)
    out, plan = collinear_sets(points_df(spark, pts), pairs_per_task=300, return_plan=True)
    assert plan.split_broadcast and not any("_slope" in line for line in _shuffles(out))
    assert as_sets(out) == brute_force_lines(pts)


def test_pages_of_bounded_groups_are_cut_where_they_are_found(spark):
    """every point of every line was range-partitioned and written."""
    out = paged_lines(_groups(spark, GROUPS), "g", page_size=3)
    assert "rangepartitioning" not in _plan(out) and "_range" not in _plan(out)
    got: dict = {}
    for r in out.collect():
        assert len(r["points"]) <= 3
        got.setdefault((r["g"], r["ux"], r["uy"], r["c"], r["n_points"]), {})[r["page"]] = [tuple(p) for p in r["points"]]
    lines = {(k[0], tuple(p for page in sorted(v) for p in v[page])) for k, v in got.items()}
    assert lines == {(g, s) for g, pts in GROUPS.items() for s in brute_force_lines(pts)}
    assert all(k[4] == sum(map(len, v.values())) and sorted(v) == list(range(len(v))) for k, v in got.items())


def test_rich_lines_and_extension_join_no_lines_with_points(spark):
    """Found lines were looked up by a join of all points and directions."""
    rich = rich_lines(_groups(spark, GROUPS), 5, "g")
    assert not any("ux" in line for line in _shuffles(rich))
    assert {(r["g"], tuple(tuple(p) for p in r["points"])) for r in rich.collect()} == {
        (g, s) for g, pts in GROUPS.items() for s in brute_force_lines(pts) if len(s) >= 5
    }
    df = _groups(spark, GROUPS)
    old, new = df.where("x % 3 > 0"), df.where("x % 3 = 0 or y = 1")
    out = extend_lines(collinear_sets(old, "g"), old, new, "g")
    assert not any("_slope" in line or "ax" in line for line in _shuffles(out))
    assert {(r["g"], tuple(tuple(p) for p in r["points"])) for r in out.collect()} == {
        (g, s) for g, pts in GROUPS.items() for s in brute_force_lines(pts)
    }


def test_fingerprints_of_bounded_groups_need_no_candidates(spark):
    """fingerprints were gathered from the candidates of a line."""
    out = line_fingerprints(_groups(spark, GROUPS), "g")
    assert "_slope" not in _plan(out)
    assert out.count() == sum(len(brute_force_lines(p)) for p in GROUPS.values())
