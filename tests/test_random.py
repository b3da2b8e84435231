"""Property tests: random small point sets against an exact brute force."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from colline.operators.lines import collinear_sets

from .conftest import as_sets, brute_force_lines, points_df

coords = st.integers(min_value=-8, max_value=8)
point_sets = st.lists(st.tuples(coords, coords), min_size=0, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pts=point_sets)
def test_random_grids(spark, pts):
    assert as_sets(collinear_sets(points_df(spark, pts))) == brute_force_lines(pts)


big = st.integers(min_value=-(2**40), max_value=2**40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(base=st.lists(st.tuples(big, big), min_size=2, max_size=6), steps=st.integers(2, 5))
def test_random_large_coordinates(spark, base, steps):
    # lines built on purpose through large coordinates, plus the base points
    pts = list(base)
    (x0, y0), (x1, y1) = base[0], base[1]
    pts += [(x0 + k * (x1 - x0) // 3, y0 + k * (y1 - y0) // 3) for k in range(steps)]
    pts = [(x, y) for x, y in pts if abs(x) < 2**45 and abs(y) < 2**45]
    assert as_sets(collinear_sets(points_df(spark, pts))) == brute_force_lines(pts)


@given(
    start=st.tuples(st.integers(-(2**55), 2**55), st.integers(-(2**55), 2**55)),
    step=st.tuples(st.integers(-(2**50), 2**50), st.integers(-(2**50), 2**50)).filter(lambda s: s != (0, 0)),
    times=st.sets(st.integers(0, 9), min_size=3, max_size=6),
)
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_exact_multiples_of_large_directions(spark, start, step, times):
    pts = [(start[0] + k * step[0], start[1] + k * step[1]) for k in times]
    got = as_sets(collinear_sets(points_df(spark, pts)))
    assert got == {tuple(sorted(pts))}
