"""The main operator on the golden fixtures, edge cases and both layouts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from colline.operators import workload as W
from colline.operators.lines import collinear_sets, line_params

from .conftest import GOLDEN8, GOLDEN9, POINTS8, POINTS9, POINTS40, as_sets, brute_force_lines, points_df


def test_points9_golden(spark):
    out = collinear_sets(points_df(spark, POINTS9))
    assert as_sets(out) == GOLDEN9
    assert out.columns == ["ux", "uy", "c", "n_points", "points"]


def test_points8_golden(spark):
    assert as_sets(collinear_sets(points_df(spark, POINTS8))) == GOLDEN8


def test_points40_profile(spark):
    out = collinear_sets(points_df(spark, POINTS40))
    sets = as_sets(out)
    assert sets == brute_force_lines(POINTS40)
    assert len(sets) == 65
    sizes = sorted(len(s) for s in sets)
    assert {k: sizes.count(k) for k in set(sizes)} == {3: 38, 4: 18, 5: 4, 6: 4, 7: 1}
    assert ((1, 0), (1, 1), (1, 2), (1, 3), (1, 5), (1, 6), (1, 8)) in sets
    rows = out.collect()
    assert sum(1 for r in rows if r["ux"] == 0) == 9  # vertical
    assert sum(1 for r in rows if r["uy"] == 0) == 9  # horizontal
    assert sum(r["n_points"] for r in rows) == 237  # rows of the by-anchor form


def test_line_key_is_exact_and_canonical(spark):
    for r in collinear_sets(points_df(spark, POINTS40)).collect():
        ux, uy, c = r["ux"], r["uy"], r["c"]
        assert ux > 0 or (ux, uy) == (0, 1)
        for p in r["points"]:
            assert ux * p["y"] - uy * p["x"] == c
        assert r["n_points"] == len(r["points"])
        assert r["points"] == sorted(r["points"], key=lambda p: (p["x"], p["y"]))


@pytest.mark.parametrize("pts", [[], [(1, 1)], [(1, 1), (2, 2)], [(1, 1), (1, 1), (1, 1)]])
def test_no_line(spark, pts):
    assert collinear_sets(points_df(spark, pts)).count() == 0


def test_duplicates_are_harmless(spark):
    assert as_sets(collinear_sets(points_df(spark, POINTS9 * 2))) == GOLDEN9


def test_one_long_line(spark):
    pts = [(i, 2 * i + 1) for i in range(100)]
    rows = collinear_sets(points_df(spark, pts)).collect()
    assert len(rows) == 1 and rows[0]["n_points"] == 100
    assert (rows[0]["ux"], rows[0]["uy"], rows[0]["c"]) == (1, 2, 1)


def test_negative_zero_horizontal(spark):
    rows = collinear_sets(points_df(spark, [(0, 0), (-3, 0), (4, 0)])).collect()
    assert [(r["ux"], r["uy"], r["c"], r["n_points"]) for r in rows] == [(1, 0, 0, 3)]


def test_intercept_split_q9(spark):
    # y - slope*x in floating point gives 0.0 and -3.55e-15 here; one line expected
    rows = collinear_sets(points_df(spark, [(0, 0), (7, 9), (21, 27)])).collect()
    assert len(rows) == 1 and rows[0]["n_points"] == 3


def test_slope_collision_q8(spark):
    a = 2**27
    assert collinear_sets(points_df(spark, [(0, 0), (a, a + 1), (a + 1, a + 2)])).count() == 0


def test_large_coordinates_exact_path(spark):
    big = 3 * 2**40
    pts = [(big + 5 * i, -big + 7 * i) for i in range(4)] + [(0, 0), (2**45, 1), (2**46, 2)]
    got = as_sets(collinear_sets(points_df(spark, pts)))
    assert got == brute_force_lines(pts)
    assert len(got) == 2


def test_min_points(spark):
    got = as_sets(collinear_sets(points_df(spark, POINTS40), min_points=5))
    assert got == brute_force_lines(POINTS40, 5)
    with pytest.raises(ValueError):
        collinear_sets(points_df(spark, POINTS9), min_points=2)


def test_grouped_and_null_group(spark):
    rows = [(g, x, y) for g in (1, 2) for x, y in POINTS9] + [(None, x, y) for x, y in POINTS8]
    df = spark.createDataFrame(rows, "g int, x bigint, y bigint")
    out = collinear_sets(df, "g")
    assert out.columns[0] == "g"
    by = {}
    for r in out.collect():
        by.setdefault(r["g"], set()).add(tuple((p["x"], p["y"]) for p in r["points"]))
    assert by == {1: GOLDEN9, 2: GOLDEN9, None: GOLDEN8}


def test_multi_column_groups(spark):
    rows = [("a", 1, x, y) for x, y in POINTS9] + [("a", 2, x, y) for x, y in POINTS8]
    out = collinear_sets(spark.createDataFrame(rows, "k string, j int, x long, y long"), ["k", "j"])
    assert out.columns[:2] == ["k", "j"]
    assert {(r["k"], r["j"]) for r in out.collect()} == {("a", 1), ("a", 2)}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _grid(n, seed):
    rnd = random.Random(seed)
    return [(rnd.randrange(-6, 7), rnd.randrange(-6, 7)) for _ in range(n)]


def test_layouts_agree_and_salting(spark):
    """Broadcast, co-partitioned and salted (hot group) layouts give the same lines."""
    groups = {g: _grid(60 if g else 150, g) for g in range(4)}
    rows = [(g, x, y) for g, pts in groups.items() for x, y in pts]
    df = spark.createDataFrame(rows, "g int, x long, y long")
    expected = {(g, s) for g, pts in groups.items() for s in brute_force_lines(pts)}

    def got(out):
        return {(r["g"], tuple((p["x"], p["y"]) for p in r["points"])) for r in out.collect()}

    base, plan = collinear_sets(df, "g", return_plan=True)
    assert plan.broadcast and plan.hot_groups == 0
    assert got(base) == expected
    assert "BroadcastHashJoin" in _plan(base)
    shuffled, plan = collinear_sets(df, "g", broadcast_max_bytes=0, return_plan=True)
    assert not plan.broadcast and "SortMergeJoin" in _plan(shuffled) and "BroadcastHashJoin" not in _plan(shuffled)
    assert got(shuffled) == expected
    split, plan = collinear_sets(df, "g", pairs_per_task=500, return_plan=True)
    assert plan.hot_groups != 0 and plan.split_broadcast
    assert got(split) == expected
    salted, plan = collinear_sets(df, "g", pairs_per_task=500, broadcast_max_bytes=0, return_plan=True)
    assert plan.hot_groups != 0 and not plan.split_broadcast
    assert got(salted) == expected


def test_global_salting(spark):
    pts = _grid(200, 7)
    out, plan = collinear_sets(points_df(spark, pts), pairs_per_task=300, return_plan=True)
    assert plan.split_broadcast and as_sets(out) == brute_force_lines(pts)
    out, plan = collinear_sets(points_df(spark, pts), pairs_per_task=300, broadcast_max_bytes=0, return_plan=True)
    assert plan.global_buckets > 1 and not plan.split_broadcast
    assert as_sets(out) == brute_force_lines(pts)


def test_one_large_group_moves_each_point_once(spark):
    pts = spark.range(400_000).selectExpr("id % 20011 as x", "(id * id) % 1000003 as y")
    out, plan = collinear_sets(pts, return_plan=True)
    assert plan.split_broadcast and "Generate" not in _plan(out) and "BroadcastHashJoin" in _plan(out)
    _, plan = collinear_sets(pts, broadcast_max_bytes=0, return_plan=True)
    assert not plan.split_broadcast
    assert plan.global_buckets <= W.SPLIT_BUCKETS_PER_CORE * W.parallelism(spark)


def test_line_constant_beyond_bigint(spark):
    for start, step, n in (((2**40, -(2**40)), (2**33 + 1, 2**33 + 5), 4), ((2**32, 2**32), (2**31 - 1, 2**31 + 11), 3)):
        pts = [(start[0] + k * step[0], start[1] + k * step[1]) for k in range(n)]
        (row,) = collinear_sets(points_df(spark, pts)).collect()
        assert row["n_points"] == n
        assert all(row["ux"] * p["y"] - row["uy"] * p["x"] == int(row["c"]) for p in row["points"])


def test_no_cartesian_product_in_plan(spark):
    out = collinear_sets(points_df(spark, POINTS40))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pairs_never_shuffled_in_colocated_layout(spark):
    rows = [(g, x, y) for g in range(3) for x, y in POINTS40]
    out = collinear_sets(spark.createDataFrame(rows, "g int, x long, y long"), "g")
    # distinct points (once for each join side) and the anchors by group; pairs and candidates stay in-stage
    shuffles = [ln for ln in _plan(out).splitlines() if "Exchange" in ln and "BroadcastExchange" not in ln]
    assert len(shuffles) == 3, _plan(out)


def test_line_params(spark):
    out = line_params(collinear_sets(points_df(spark, POINTS9)))
    got = {tuple(r[k] for k in ("is_vertical", "slope", "intercept")) for r in out.collect()}
    assert got == {(False, 1.0, 0.0), (False, 1.0, 1.0), (True, float("inf"), 0.0)}


def test_user_filters_and_explode_stay_cheap(spark):
    lines = collinear_sets(points_df(spark, POINTS40))
    assert lines.where("ux = 1 and size(points) > 3").count() == sum(
        1 for r in lines.collect() if r["ux"] == 1 and r["n_points"] > 3
    )
    assert lines.select(F.explode("points").alias("p")).select("p.x").count() == 237
