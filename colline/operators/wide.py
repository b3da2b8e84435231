"""Lines of points whose coordinates go beyond BIGINT: DECIMAL(38,0) of up to 31 digits.

The pair stage is that of :mod:`colline.operators.lines`: same sizing job, same
layouts, pairs formed and grouped in one stage.  Only the arithmetic differs.  A
direction's key is its slope in as many decimal places as tell any two slopes
apart: with differences up to D, two different ones are at least 1 / D^2 apart.
The places come from a long division of a few steps, so pairs need no gcd; a line
needs one.  The line constant ux*y - uy*x has up to 63 digits; it is computed from
halves of 16 digits and returned as two columns, c = c_hi * 10^32 + c_lo with
0 <= c_lo < 10^32.

31 digits is what leaves room for the steps of the division and for an exact
decimal quotient (DECIMAL(38,6)) of a difference.  BIGINT points stay with
:func:`colline.operators.lines.collinear_sets`, which is faster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from colline.functions.geometry import gcd_bounded, int_div
from colline.operators.lines import Prepared, _as_list, _flat_keys, _pt, point_rows, prepared, restore_groups, split_pairs
from colline.operators.rays import array_lines
from colline.sources.storage import materialize
from colline.sources.text import POINT_LINE_PATTERN, _check_mode, ref, require

WIDE = "decimal(38,0)"
DIGITS = 31
# A line of two integers of at most DIGITS digits besides leading zeros.
WIDE_LINE_PATTERN = f"^[+-]?0*[0-9]{{1,{DIGITS}}} [+-]?0*[0-9]{{1,{DIGITS}}}$"
HALF = 10**16
BIGINT_DIFFERENCE = 1 << 62


def _lit(n: int) -> Column:
    return F.lit(str(n)).cast(WIDE)


def _wide(c: Column) -> Column:
    return c.cast(WIDE)


def wide_div(a: Column, b: Column) -> Column:
    """a / b for a b that divides a (``div`` would give a BIGINT)."""
    return (a / b).cast(WIDE)


def wide_gcd(a: Column, b: Column) -> Column:
    """Greatest common divisor of two non-negative columns of at most 32 digits."""
    hi, lo = F.greatest(a, b), F.least(a, b)
    # Lame's bound on the smaller argument
    steps = (F.ceil(F.log2(lo.cast("double") + F.lit(1.0)) * F.lit(1.45)) + F.lit(3)).cast("int")

    def step(z: Column, _i: Column) -> Column:
        return F.when(z["b"] == 0, z).otherwise(F.struct(z["b"].alias("a"), _wide(z["a"] % z["b"]).alias("b")))

    fold = F.aggregate(
        F.sequence(F.lit(1), steps), F.struct(_wide(hi).alias("a"), _wide(lo).alias("b")), step, lambda z: z["a"]
    )
    fits = hi < _lit(BIGINT_DIFFERENCE)
    near = gcd_bounded(F.when(fits, hi).otherwise(F.lit(0)), F.when(fits, lo).otherwise(F.lit(0)), BIGINT_DIFFERENCE)
    return F.when(lo == 0, hi).when(fits, _wide(near)).otherwise(fold)


def line_constant(ux: Column, uy: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """(c_hi, c_lo) of ux*y - uy*x, exact."""
    half = _lit(HALF)

    def parts(n: Column) -> tuple[Column, Column]:
        low = _wide(n % half)
        return wide_div(n - low, half), low

    (u1, u0), (v1, v0), (x1, x0), (y1, y0) = map(parts, (ux, uy, x, y))
    high = _wide(_wide(u1 * y1) - _wide(v1 * x1))
    middle = _wide(_wide(u1 * y0) + _wide(u0 * y1) - _wide(v1 * x0) - _wide(v0 * x1))
    low = _wide(_wide(u0 * y0) - _wide(v0 * x0))
    m0 = _wide(F.pmod(middle, half))
    rest = _wide(low + _wide(m0 * half))
    c_lo = _wide(F.pmod(rest, _lit(HALF * HALF)))
    c_hi = high + wide_div(middle - m0, half) + wide_div(rest - c_lo, _lit(HALF * HALF))
    return _wide(c_hi), c_lo


def _in_range(x: Column, y: Column) -> Column:
    most = _lit(10**DIGITS)
    return F.coalesce((F.abs(x) < most) & (F.abs(y) < most), F.lit(False))


def parse_wide_points(df: DataFrame, col: str = "value", mode: str = "strict", keep_input: bool = True):
    """``"x y"`` lines of integers of up to 31 digits into ``x, y DECIMAL(38,0)``.

    The format and the modes are those of :func:`colline.sources.text.parse_points`.
    """
    _check_mode(mode)
    value = ref(col)
    numbers = F.split(value, " ", -1)
    shaped = value.rlike(POINT_LINE_PATTERN)
    x, y = (F.when(shaped, numbers[k].try_cast(WIDE)) for k in (0, 1))
    ok = _in_range(x, y)
    reason = (
        F.when(value.isNull(), F.lit("null line"))
        .when(~shaped, F.lit("not two integers separated by one space"))
        .when(~ok, F.lit(f"integer of more than {DIGITS} digits"))
    )
    base = [ref(c) for c in df.columns] if keep_input else []
    if mode == "strict":
        # one match says all that ``ok`` does; repeated casts in one filter make code too long to compile
        fits = F.coalesce(value.rlike(WIDE_LINE_PATTERN), F.lit(False))
        message = F.concat(F.lit("bad point line ("), reason, F.lit("): "), F.coalesce(value, F.lit("NULL")))
        return require(df, fits, message).select(*base, *[numbers[k].try_cast(WIDE).alias(c) for k, c in ((0, "x"), (1, "y"))])
    return df.where(ok).select(*base, x.alias("x"), y.alias("y")), df.where(~ok).select(*[ref(c) for c in df.columns], reason.alias("reason"))


def wide_points(df: DataFrame, x: str, y: str, group_cols: Sequence[str] = (), mode: str = "strict"):
    """Points from two integer or DECIMAL columns: ``group cols..., x, y DECIMAL(38,0)``.

    Strict mode fails on a NULL, fractional or longer value; permissive mode
    returns ``(points, rejects)``, the rejects with all their columns.
    """
    _check_mode(mode)
    for c in (x, y):
        if not isinstance(df.schema[c].dataType, (IntegralType, DecimalType)):
            raise ValueError(f"column {c!r} is neither an integer nor a decimal; parse text with parse_wide_points")
    xs, ys = ref(x), ref(y)
    xi, yi = xs.try_cast(WIDE), ys.try_cast(WIDE)
    # a comparison with the cast value would round both sides to one scale
    ok = _in_range(xi, yi)
    for c, v in ((x, xs), (y, ys)):
        if getattr(df.schema[c].dataType, "scale", 0) > 0:
            ok = ok & F.coalesce(v % F.lit(1) == 0, F.lit(False))
    out = [*[ref(c) for c in group_cols], xi.alias("x"), yi.alias("y")]
    if mode == "permissive":
        return df.where(ok).select(*out), df.where(~ok)
    shown = [F.coalesce(c.cast("string"), F.lit("NULL")) for c in (xs, ys)]
    message = F.concat(F.lit("not an integer point: "), shown[0], F.lit(" "), shown[1])
    return require(df, ok, message).select(*out)


SLOPE = ["_q0", "_q1", "_q2"]


def division_steps(max_abs: int) -> tuple[int, int]:
    """(places of a step, steps) so that slopes of differences up to 2 * max_abs get different keys.

    A step multiplies a remainder of at most half the divisor (and a little) by
    10^places, which has to stay below 10^38, and its quotient below 10^32.
    """
    digits = len(str(2 * max_abs))
    places = min(31, 37 - digits)
    return places, -(-(2 * digits + 1) // places)


def slope_key(dx: Column, dy: Column, max_abs: int) -> Column:
    """Struct of :data:`SLOPE`: the rounded slope and its places in two numbers; equal exactly for parallel pairs.

    Digits are rounded quotients, so they may be negative; each depends on the
    slope alone.  A vertical pair has a key that no slope has.
    """
    places, steps = division_steps(max_abs)
    half = -(-steps // 2)
    base = _lit(10**places)
    by = F.when(dx == 0, _lit(1)).otherwise(dx)
    rounded = lambda r: _wide(r / by)
    first = rounded(dy)
    init = F.struct(_wide(dy - _wide(first * by)).alias("r"), first.alias("q0"), _lit(0).alias("q1"), _lit(0).alias("q2"))

    def step(z: Column, i: Column) -> Column:
        t = _wide(z["r"] * base)
        d = rounded(t)
        return F.struct(
            _wide(t - _wide(d * by)).alias("r"), z["q0"].alias("q0"),
            F.when(i <= half, _wide(_wide(z["q1"] * base) + d)).otherwise(z["q1"]).alias("q1"),
            F.when(i > half, _wide(_wide(z["q2"] * base) + d)).otherwise(z["q2"]).alias("q2"),
        )

    done = F.aggregate(F.array(*[F.lit(i + 1) for i in range(steps)]), init, step)
    none = F.struct(F.lit(None).cast(WIDE).alias("r"), *[F.lit(None).cast(WIDE).alias(q) for q in ("q0", "q1", "q2")])
    return F.when(dx == 0, none).otherwise(done)


def _candidates(joined: DataFrame, part_cols: list[str], max_abs: int) -> DataFrame:
    """Anchors with two or more partners in one direction: count, nearest and farthest partner."""
    dx, dy = _wide(F.col("bx") - F.col("ax")), _wide(F.col("by_") - F.col("ay"))
    ends = F.struct(F.col("bx").alias("x"), F.col("by_").alias("y"))  # (x, y) order is the order along the ray
    keyed = joined.select(*part_cols, "ax", "ay", ends.alias("_b"), slope_key(dx, dy, max_abs).alias("_q"))
    keyed = keyed.select(*part_cols, "ax", "ay", "_b", *[F.col("_q")[q[1:]].alias(q) for q in SLOPE])
    group = list(dict.fromkeys([*part_cols, "ax", "ay"]))
    found = keyed.groupBy(*group, *SLOPE).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_b").alias("_near"), F.max("_b").alias("_far"))
    return found.where(F.col("_cnt") >= 2).drop("_bucket")


def _lines(cand: DataFrame, keys: list[str], min_points: int) -> DataFrame:
    lines = cand.groupBy(*keys, *SLOPE, "_far").agg(
        (F.max("_cnt") + F.lit(1)).alias("n_points"), F.collect_list(_pt("ax", "ay")).alias("_anchors"), F.min_by("_near", "_cnt").alias("_pen")
    )
    points = F.sort_array(F.concat(F.col("_anchors"), F.array(F.col("_pen"), F.col("_far"))))
    dx, dy = (_wide(F.col("_far")[c] - F.col("_pen")[c]) for c in ("x", "y"))
    lines = lines.where(F.col("n_points") >= F.lit(min_points)).select(*keys, "n_points", "_far", points.alias("points"), dx.alias("_dx"), dy.alias("_dy"))
    lines = lines.withColumn("_g", wide_gcd(F.col("_dx"), F.abs(F.col("_dy"))))
    lines = lines.withColumn("ux", wide_div(F.col("_dx"), F.col("_g"))).withColumn("uy", wide_div(F.col("_dy"), F.col("_g")))
    c_hi, c_lo = line_constant(F.col("ux"), F.col("uy"), F.col("_far")["x"], F.col("_far")["y"])
    return lines.select(*keys, "ux", "uy", c_hi.alias("c_hi"), c_lo.alias("c_lo"), "n_points", "points")


def wide_collinear_sets(
    points: DataFrame, group_cols: str | Sequence[str] | None = None, x: str = "x", y: str = "y", min_points: int = 3,
    *, pairs_per_task: int | None = None, broadcast_max_bytes: int | None = None,
) -> DataFrame:
    """Every maximal set of ``min_points`` or more collinear points, one row per line.

    Output: group columns, ``ux, uy`` (as in ``collinear_sets``, DECIMAL(38,0)), the
    line constant as ``c_hi, c_lo``, ``n_points`` and ``points``
    (``ARRAY<STRUCT<x, y>>`` of DECIMAL(38,0), sorted).  A NULL, fractional or
    longer coordinate fails the job; repeated points count once; a NULL group
    key is a group of its own.
    """
    if min_points < 3:
        raise ValueError("min_points must be at least 3 (any two points share a line)")
    gcols = _as_list(group_cols)
    named = points.select(*[ref(c).alias(k) for c, k in zip(gcols, _flat_keys(gcols))], ref(x).alias("_x"), ref(y).alias("_y"))
    # read by the sizing job and twice by the search: parsed and made distinct once where there is a checkpoint folder
    pts = materialize(wide_points(named, "_x", "_y", _flat_keys(gcols)).dropDuplicates(), "wide-points")
    # a wide point takes twice the bytes that the sizing job counts for one
    bytes_bound = {} if broadcast_max_bytes is None else {"broadcast_max_bytes": broadcast_max_bytes // 2}
    prep: Prepared = prepared(pts, gcols, pairs_per_task=pairs_per_task, **bytes_bound)
    rows, rest = point_rows(prep)
    parts = []
    for r in rows:
        found = array_lines(r, prep.keys, False, min_points)
        parts.append(found.withColumn("n_points", F.size("points").cast("bigint")).select(*prep.keys, "ux", "uy", "c_hi", "c_lo", "n_points", "points"))
    if rest is not None:
        joined, part_cols = split_pairs(rest, prep.keys, prep.plan)
        spread = _candidates(joined, part_cols, prep.plan.max_abs).repartition(*prep.keys, *SLOPE, "_far")
        parts.append(_lines(spread, prep.keys, min_points))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return restore_groups(out, prep)
