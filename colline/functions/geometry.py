"""Native column expressions for points, directions and line keys.

Everything here is a plain ``Column`` built from ``pyspark.sql.functions``;
nothing runs in a Python worker.  The higher-order ``aggregate`` used by
:func:`gcd` is not code-generated, which is why the per-pair key
(:func:`direction_key`) only calls it for very large differences.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a direction (dx, dy) whose components are both below this bound
# is keyed by the double dy/dx.  Two different reduced fractions p/q and r/s with
# all parts below 2**26 differ relatively by more than 2**-52, so their correctly
# rounded quotients are different doubles; equal fractions give the same double
# because IEEE division is correctly rounded.
EXACT_DOUBLE_BOUND = 1 << 26

INFINITY = float("inf")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lex_less(ax: Column, ay: Column, bx: Column, by_: Column) -> Column:
    """(ax, ay) < (bx, by) in (x, y) order: the half-pair predicate."""
    return (ax < bx) | ((ax == bx) & (ay < by_))


def int_div(a: str | Column, b: str | Column) -> Column:
    """BIGINT division truncating toward zero (SQL ``div``), never through DOUBLE."""
    return F.call_function("div", _c(a).cast("bigint"), _c(b).cast("bigint"))


def gcd(a: str | Column, b: str | Column) -> Column:
    """Greatest common divisor of two non-negative BIGINT columns.

    Spark SQL has no ``gcd``; this is Euclid's algorithm folded with the
    higher-order ``aggregate``.  The fold length is Lame's bound for the larger
    argument (about 1.44 * log2 + 2 steps, 92 at 2**62), so small values cost a
    handful of steps.  ``gcd(0, 0) = 0``.
    """
    a, b = _c(a), _c(b)
    m = F.greatest(a, b).cast("double")
    steps = (F.ceil(F.log2(m + F.lit(1.0)) * F.lit(1.45)) + F.lit(2)).cast("int")
    init = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))

    def step(z: Column, _i: Column) -> Column:
        return F.when(z["b"] == 0, z).otherwise(
            F.struct(z["b"].alias("a"), (z["a"] % z["b"]).alias("b"))
        )

    return F.aggregate(F.sequence(F.lit(1), steps), init, step, lambda z: z["a"])


def slope(dx: str | Column, dy: str | Column) -> Column:
    """Slope dy/dx as DOUBLE, ``+Infinity`` when dx = 0 (vertical), NULL when both are 0.

    The reference keys vertical pairs with the string ``"inf"``; a DOUBLE
    ``Infinity`` groups the same way and never mixes types.  ``+ 0.0`` turns
    ``-0.0`` into ``0.0`` so that results hash like other engines' results.
    """
    dx, dy = _c(dx), _c(dy)
    return (
        F.when((dx == 0) & (dy == 0), F.lit(None).cast("double"))
        .when(dx == 0, F.lit(INFINITY))
        .otherwise(dy.cast("double") / dx.cast("double") + F.lit(0.0))
    )


def is_small_direction(dx: str | Column, dy: str | Column) -> Column:
    """Both components below :data:`EXACT_DOUBLE_BOUND` (dx >= 0 assumed)."""
    bound = F.lit(EXACT_DOUBLE_BOUND)
    return (_c(dx) < bound) & (F.abs(_c(dy)) < bound)


def direction_divisor(dx: str | Column, dy: str | Column) -> Column:
    """gcd(dx, |dy|) where :func:`direction_key` needs it, else 1 (no fold is run)."""
    dx, dy = _c(dx), _c(dy)
    return F.when(is_small_direction(dx, dy) | (dx == 0), F.lit(1).cast("bigint")).otherwise(
        gcd(dx, F.abs(dy))
    )


def direction_key(
    dx: str | Column, dy: str | Column, divisor: str | Column | None = None
) -> tuple[Column, Column, Column]:
    """Exact grouping key of a direction with dx >= 0 (and dy > 0 when dx = 0).

    Returns three columns ``(slope, ex_ux, ex_uy)``:

    * small components (both below :data:`EXACT_DOUBLE_BOUND`): ``(dy/dx, 0, 0)``,
      vertical ``(+Infinity, 0, 0)``.  No gcd is evaluated, so the per-pair
      cost is one division inside generated code.
    * large components: the direction is reduced by its gcd; if the reduced
      direction is small it gets the same double as above (same rational,
      same correctly rounded quotient), otherwise ``(NULL, ux, uy)`` exactly.

    Two pairs get the same key exactly when their directions are parallel.
    ``divisor`` is :func:`direction_divisor` computed once in an earlier
    projection (recommended: the gcd fold then appears once per row).
    """
    dx, dy = _c(dx), _c(dy)
    g = direction_divisor(dx, dy) if divisor is None else _c(divisor)
    bound = F.lit(EXACT_DOUBLE_BOUND)
    small = is_small_direction(dx, dy)
    ux = int_div(dx, g)
    uy = int_div(dy, g)
    reduced_small = (ux < bound) & (F.abs(uy) < bound)
    slope_key = (
        F.when(dx == 0, F.lit(INFINITY))
        .when(small, dy.cast("double") / dx.cast("double") + F.lit(0.0))
        .when(reduced_small, uy.cast("double") / ux.cast("double") + F.lit(0.0))
        .otherwise(F.lit(None).cast("double"))
    )
    exact = F.when(small | (dx == 0), F.lit(False)).otherwise(~reduced_small)
    ex_ux = F.when(exact, ux).otherwise(F.lit(0).cast("bigint"))
    ex_uy = F.when(exact, uy).otherwise(F.lit(0).cast("bigint"))
    return slope_key, ex_ux, ex_uy


def points_text(points: str | Column) -> Column:
    """``ARRAY<STRUCT<x,y>>`` to ``'x y;x y;...'`` in array order (for cross-engine checks)."""
    return F.array_join(
        F.transform(_c(points), lambda p: F.concat(p["x"].cast("string"), F.lit(" "), p["y"].cast("string"))),
        ";",
    )


def euclid_steps(bound: int) -> int:
    """Division steps that always finish Euclid's algorithm on inputs <= ``bound``.

    Lame: about log_phi(sqrt(5) * bound) = 1.4405 * log2(bound) + 1.67 steps, plus
    one for a first swap when a < b.
    """
    import math

    return max(1, math.ceil(1.45 * math.log2(max(1, bound) + 1)) + 3)


def gcd_bounded(a: str | Column, b: str | Column, bound: int) -> Column:
    """gcd of two non-negative BIGINT columns known to be at most ``bound``.

    Trivial cases (a zero, a one, one value dividing the other) are answered
    directly; the rest run Euclid's fold for Lame's number of steps of the
    smaller value (never more than :func:`euclid_steps` of ``bound``).
    (An unrolled fold as stacked projections would be faster, but any filter a
    caller puts on top gets pushed down through them with every alias inlined,
    which grows exponentially; a single expression keeps plans small.)
    """
    a, b = _c(a).cast("bigint"), _c(b).cast("bigint")
    hi, lo = F.greatest(a, b), F.least(a, b)
    init = F.struct(hi.alias("a"), lo.alias("b"))

    def step(z: Column, _i: Column) -> Column:
        return F.when(z["b"] == 0, z).otherwise(F.struct(z["b"].alias("a"), (z["a"] % z["b"]).alias("b")))

    # Lame's bound on the smaller argument (the fold starts ordered, no swap step)
    per_row = (F.ceil(F.log2(lo.cast("double") + F.lit(1.0)) * F.lit(1.45)) + F.lit(2)).cast("int")
    steps = F.least(F.lit(euclid_steps(bound)), per_row)
    fold = F.aggregate(F.sequence(F.lit(1), steps), init, step, lambda z: z["a"])
    return (
        F.when(lo == 0, hi)
        .when(lo == 1, F.lit(1).cast("bigint"))
        .when(hi % lo == 0, lo)
        .otherwise(fold)
    )
