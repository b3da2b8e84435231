"""Scalar expressions: slope, gcd, exact direction keys (F-6, Q5, Q7, Q8)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from colline.functions.geometry import (
    direction_key,
    euclid_steps,
    gcd,
    gcd_bounded,
    int_div,
    points_text,
    slope,
)


def test_slope_values_f6(spark):
    rows = [((1, 2), (-7, -2)), ((1, 2), (3, 4)), ((1, 2), (1, 5)), ((1, 2), (2, 5))]
    df = spark.createDataFrame([(a[0], a[1], b[0], b[1]) for a, b in rows], "ax long, ay long, bx long, by_ long")
    got = [r[0] for r in df.select(slope(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by_"))).collect()]
    assert got == [0.5, 1.0, float("inf"), 3.0]


def test_slope_negative_zero_and_self_pair(spark):
    df = spark.createDataFrame([(-3, 0), (0, 0)], "dx long, dy long")
    got = [r[0] for r in df.select(slope("dx", "dy")).collect()]
    assert got[0] == 0.0 and math.copysign(1.0, got[0]) == 1.0  # never -0.0
    assert got[1] is None


def test_gcd_matches_math(spark):
    vals = [(0, 0), (0, 7), (7, 0), (12, 18), (1, 1), (2**62, 2**61), (10**18 + 9, 10**18 + 7), (48, 180)]
    df = spark.createDataFrame(vals, "a long, b long")
    got = [r[0] for r in df.select(gcd("a", "b")).collect()]
    assert got == [math.gcd(a, b) for a, b in vals]
    bounded = [r[0] for r in df.select(gcd_bounded(F.col("a"), F.col("b"), 2**62)).collect()]
    assert bounded == [math.gcd(a, b) for a, b in vals]


def test_euclid_steps_bound_is_enough():
    # consecutive Fibonacci numbers are Euclid's worst case
    fib = [1, 1]
    while fib[-1] < 2**62:
        fib.append(fib[-1] + fib[-2])
    for i in range(2, len(fib) - 1):
        a, b, steps = fib[i + 1], fib[i], 0
        while b:
            a, b = b, a % b
            steps += 1
        assert steps <= euclid_steps(fib[i + 1])


def test_int_div_is_exact_for_large_values(spark):
    df = spark.createDataFrame([(2**62 + 6, 2)], "a long, b long")
    assert df.select(int_div("a", "b")).first()[0] == (2**62 + 6) // 2


def test_direction_key_separates_the_2_27_collision(spark):
    a = 2**27
    # (a+1)/a and (a+2)/(a+1) are the same double but different directions (Q8)
    assert (a + 1) / a == (a + 2) / (a + 1)
    df = spark.createDataFrame([(a, a + 1), (a + 1, a + 2), (2 * a, 2 * a + 2)], "dx long, dy long")
    keys = [tuple(r) for r in df.select(*direction_key("dx", "dy")).collect()]
    assert keys[0] != keys[1]
    assert keys[0] == keys[2]  # (2a, 2a+2) reduces to (a, a+1)


def test_direction_key_small_and_reduced_agree(spark):
    # (3, 6) is small; (3 * 2**40, 6 * 2**40) is large but reduces to (1, 2)
    df = spark.createDataFrame([(3, 6), (3 * 2**40, 6 * 2**40), (0, 5), (0, 2**50)], "dx long, dy long")
    keys = [tuple(r) for r in df.select(*direction_key("dx", "dy")).collect()]
    assert keys[0] == keys[1] == (2.0, 0, 0)
    assert keys[2] == keys[3] == (float("inf"), 0, 0)


def test_points_text(spark):
    df = spark.createDataFrame([([(1, -2), (3, 4)],)], "p array<struct<x:bigint,y:bigint>>")
    assert df.select(points_text("p")).first()[0] == "1 -2;3 4"


def test_gcd_bounded_worst_cases_and_random(spark):
    import random

    fib = [1, 2]
    while fib[-1] < 2**61:
        fib.append(fib[-1] + fib[-2])
    rnd = random.Random(3)
    vals = [(fib[i + 1], fib[i]) for i in range(len(fib) - 1)] + [(fib[i], fib[i + 1]) for i in range(len(fib) - 1)]
    vals += [(rnd.randrange(0, 10**6), rnd.randrange(0, 10**6)) for _ in range(300)]
    vals += [(k * 6, k * 10) for k in range(1, 50)]
    df = spark.createDataFrame(vals, "a long, b long")
    got = [r[0] for r in df.select(gcd_bounded(F.col("a"), F.col("b"), 2**62)).collect()]
    assert got == [math.gcd(a, b) for a, b in vals]
