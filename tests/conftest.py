from __future__ import annotations

import os
import sys
from fractions import Fraction
from itertools import combinations

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata"

# Fixed values, F-1: the nine points of the worked example and its three golden sets.
POINTS9 = [(1, 1), (0, 1), (2, 2), (3, 3), (0, 5), (3, 4), (5, 6), (0, -3), (-2, -2)]
GOLDEN9 = {
    ((-2, -2), (1, 1), (2, 2), (3, 3)),
    ((0, 1), (3, 4), (5, 6)),
    ((0, -3), (0, 1), (0, 5)),
}

# Fixed values, F-2: the 40 distinct points that occur in the 65 golden sets of the second file.
POINTS40 = [
    (0, 2), (0, 3), (0, 4), (0, 5), (0, 7), (0, 8), (1, 0), (1, 1), (1, 2), (1, 3),
    (1, 5), (1, 6), (1, 8), (2, 0), (2, 4), (2, 5), (3, 1), (3, 3), (3, 6), (4, 3),
    (4, 5), (4, 6), (5, 0), (5, 2), (5, 7), (5, 9), (6, 0), (6, 1), (6, 5), (6, 9),
    (7, 2), (7, 3), (7, 4), (7, 6), (7, 8), (8, 1), (8, 9), (9, 3), (9, 4), (9, 5),
]

# Fixed values, F-3.
POINTS8 = [(4, -2), (2, -1), (-3, 4), (6, 3), (-9, 4), (6, -3), (8, -4), (6, 9)]
GOLDEN8 = {((6, -3), (6, 3), (6, 9)), ((2, -1), (4, -2), (6, -3), (8, -4))}


def brute_force_lines(points, min_points=3):
    """Every maximal set of >= min_points collinear points, with exact fractions."""
    pts = sorted(set(points))
    lines: dict[tuple, set] = {}
    for (ax, ay), (bx, by) in combinations(pts, 2):
        if ax == bx:
            key = ("v", Fraction(ax))
        else:
            s = Fraction(by - ay, bx - ax)
            key = ("s", s, Fraction(ay) - s * ax)
        lines.setdefault(key, set()).update({(ax, ay), (bx, by)})
    return {tuple(sorted(v)) for v in lines.values() if len(v) >= min_points}


def as_sets(df, col="points"):
    return {tuple((p["x"], p["y"]) for p in r[col]) for r in df.select(col).collect()}


@pytest.fixture(scope="session")
def spark():
    from colline.session import local_session

    s = local_session("4", shuffle_partitions=8, app="colline-tests")
    yield s
    s.stop()


def points_df(spark, pts, group=None):
    if group is None:
        return spark.createDataFrame(list(pts), "x bigint, y bigint")
    return spark.createDataFrame([(group, x, y) for x, y in pts], "g int, x bigint, y bigint")
