"""Points beyond BIGINT: exact directions and line constants, parsing, layouts."""

import random
from decimal import Decimal
from math import gcd

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from colline import collinear_sets, parse_wide_points, wide_collinear_sets, wide_points
from colline.operators.wide import division_steps, line_constant, wide_gcd
from tests.conftest import brute_force_lines

SCHEMA = "g string, x decimal(38,0), y decimal(38,0)"


def _rows(points, g="a"):
    return [(g, Decimal(x), Decimal(y)) for x, y in points]


def _found(df):
    return {tuple((int(p["x"]), int(p["y"])) for p in r.points) for r in df.collect()}


def _check_keys(df):
    for r in df.collect():
        c = int(r.c_hi) * 10**32 + int(r.c_lo)
        assert 0 <= int(r.c_lo) < 10**32
        assert gcd(int(r.ux), int(r.uy)) == 1 and (r.ux > 0 or (r.ux, r.uy) == (0, 1))
        assert all(int(r.ux) * int(p["y"]) - int(r.uy) * int(p["x"]) == c for p in r.points)
        assert r.n_points == len(r.points)


def _points(rnd, scale, n=14):
    """A few random points and integer combinations of them, so that long lines of large steps exist."""
    base = [(rnd.randint(-scale, scale), rnd.randint(-scale, scale)) for _ in range(n // 2)]
    out = set(base)
    while len(out) < n:
        (ax, ay), (bx, by) = rnd.sample(base, 2)
        out.add((2 * bx - ax, 2 * by - ay))
    return [(x, y) for x, y in out if max(abs(x), abs(y)) < 10**31]


@settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.generate])
@given(st.integers(0, 10**6), st.sampled_from([4, 2**62, 2**70, 10**30, 10**31 // 3]))
def test_equals_brute_force_beyond_bigint(spark, seed, scale):
    points = _points(random.Random(seed), scale)
    found = wide_collinear_sets(spark.createDataFrame(_rows(points), SCHEMA))
    assert _found(found) == brute_force_lines(points)
    _check_keys(found)


@pytest.mark.parametrize("layout", [{}, {"pairs_per_task": 20}, {"broadcast_max_bytes": 0}, {"pairs_per_task": 20, "broadcast_max_bytes": 0}])
def test_groups_in_every_layout(spark, layout):
    rnd = random.Random(4)
    groups = {g: _points(rnd, 2**80, 10 + 8 * k) for k, g in enumerate(["a", "b", None])}
    rows = [r for g, points in groups.items() for r in _rows(points, g) * 2]
    found = wide_collinear_sets(spark.createDataFrame(rows, SCHEMA), "g", **layout)
    _check_keys(found)
    got = {g: set() for g in groups}
    for r in found.collect():
        got[r.g].add(tuple((int(p["x"]), int(p["y"])) for p in r.points))
    assert got == {g: brute_force_lines(points) for g, points in groups.items()}


def test_equals_the_bigint_search_on_small_points(spark):
    rnd = random.Random(9)
    rows = [("a", rnd.randint(-6, 6), rnd.randint(-6, 6)) for _ in range(40)]
    df = spark.createDataFrame(rows, "g string, x long, y long")
    wide = {(int(r.ux), int(r.uy), int(r.c_hi) * 10**32 + int(r.c_lo), r.n_points) for r in wide_collinear_sets(df).collect()}
    assert wide == {(r.ux, r.uy, int(r.c), r.n_points) for r in collinear_sets(df).collect()}


def test_gcd_and_line_constant(spark):
    rnd = random.Random(1)
    rows = [(rnd.randint(-(10**e), 10**e), rnd.randint(-(10**f), 10**f)) for e in (0, 9, 18, 30) for f in (0, 9, 20, 30) for _ in range(6)]
    rows += [(2 * 10**31 - 1, 2 * 10**31 - 3), (7**30, 7**20), (0, 10**30), (2**62, 2**61)]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in rows], "a decimal(38,0), b decimal(38,0)")
    hi, lo = line_constant(F.col("a"), F.col("b"), F.col("b"), -F.col("a"))
    g = wide_gcd(F.abs(F.col("a")), F.abs(F.col("b")))
    for r in df.select("a", "b", g.alias("g"), hi.alias("hi"), lo.alias("lo")).collect():
        a, b = int(r.a), int(r.b)
        assert int(r.g) == gcd(a, b)
        assert int(r.hi) * 10**32 + int(r.lo) == -a * a - b * b


def test_parse_modes_and_range(spark):
    big = "9" * 31
    lines = [f"{big} -{big}", "1 2", "+0003 -0", "0" * 60 + "7 1", "1" + "0" * 31 + " 1", "9" * 50 + " 1", "1  2", "1.5 2", "", None, "1 2 3"]
    df = spark.createDataFrame([(v, 1) for v in lines], "value string, x int")
    good, bad = parse_wide_points(df, mode="permissive", keep_input=False)
    assert {(int(r.x), int(r.y)) for r in good.collect()} == {(int(big), -int(big)), (1, 2), (3, 0), (7, 1)}
    assert sorted(r.reason for r in bad.collect()) == sorted(
        ["integer of more than 31 digits"] * 2 + ["not two integers separated by one space"] * 4 + ["null line"]
    )
    with pytest.raises(Exception, match="bad point line"):
        parse_wide_points(df).collect()


def test_columns_and_edges(spark):
    df = spark.createDataFrame(
        [(Decimal("1.5"), 1), (Decimal("2"), 2), (None, 3), (Decimal("1e31"), 4)], "x decimal(38,2), y int"  # 1e31: too long
    )
    good, bad = wide_points(df, "x", "y", mode="permissive")
    assert [(int(r.x), int(r.y)) for r in good.collect()] == [(2, 2)] and bad.count() == 3
    with pytest.raises(Exception, match="not an integer point"):
        wide_collinear_sets(df).collect()
    with pytest.raises(ValueError, match="neither an integer"):
        wide_points(spark.createDataFrame([(1.0, 2.0)], "x double, y double"), "x", "y")
    empty = spark.createDataFrame([], SCHEMA)
    assert wide_collinear_sets(empty, "g").collect() == [] and wide_collinear_sets(empty).collect() == []


def test_slopes_that_differ_least_have_different_keys(spark):
    """Neighbouring fractions n/(n+1) and (n-1)/n are as close as slopes of their size can be."""
    for n in (10**9, 2**62, 10**30):
        points = [(0, 0), (n + 1, n), (n, n - 1), (2 * n + 2, 2 * n), (-n, 1 - n)]
        df = spark.createDataFrame(_rows(points), SCHEMA)
        assert _found(wide_collinear_sets(df)) == brute_force_lines(points)
    for max_abs in (1, 10**9, 10**30, 10**31 - 1):
        places, steps = division_steps(max_abs)
        assert 0 < places < 32 and 10 ** (places * steps) > 2 * (2 * max_abs) ** 2
        assert places * -(-steps // 2) < 38
