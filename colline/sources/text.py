"""Point sources: ``"x y"`` text lines and numeric columns of any DataFrame.

Text format (fixed by the reference): one point per line, two integers
separated by exactly one ASCII space.  ``mode="strict"`` fails the job on the
first line that is not two integers (the reference fails too, on ``int('')``);
``mode="permissive"`` keeps going and returns the bad lines separately.

Known differences from the reference's Python ``int``: underscores (``1_000``),
non-ASCII digits and tabs around a number are rejected here; a third field is
rejected here (the reference ignores it).  Values must fit in BIGINT.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Fixed value: the accepted line shape, two optionally signed integers and one space.
POINT_LINE_PATTERN = r"^[+-]?[0-9]+ [+-]?[0-9]+$"
# Integers of up to 18 digits always fit BIGINT: nearly every line passes this one match.
SHORT_LINE_PATTERN = r"^[+-]?[0-9]{1,18} [+-]?[0-9]{1,18}$"

MODES = ("strict", "permissive")


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")


def ref(name: str) -> Column:
    """The column of exactly this name (a dot or back-quote in it is part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def require(df: DataFrame, ok: Column, message: Column) -> DataFrame:
    """``df``, failing the job on the first row that is not ``ok``.

    The check is a filter, not an output column, so it runs even if nobody
    reads the checked columns (``count()`` fails too).
    """
    return df.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def _parsed(value: Column) -> tuple[Column, Column, Column, Column]:
    """(x, y, ok, reason) for a text column; x, y are NULL when not ok."""
    parts = F.split(value, " ", -1)
    shaped = value.rlike(POINT_LINE_PATTERN)
    x = F.when(shaped, parts[0].try_cast("bigint"))
    y = F.when(shaped, parts[1].try_cast("bigint"))
    ok = F.coalesce(shaped & x.isNotNull() & y.isNotNull(), F.lit(False))
    reason = (
        F.when(value.isNull(), F.lit("null line"))
        .when(~shaped, F.lit("not two integers separated by one space"))
        .when(x.isNull() | y.isNull(), F.lit("integer out of BIGINT range"))
    )
    return x, y, ok, reason


def parse_points(df: DataFrame, col: str = "value", mode: str = "strict", keep_input: bool = True):
    """Parse a text column into ``x, y BIGINT``.

    ``strict``: returns the DataFrame with ``x, y`` added; any bad line raises
    when the plan runs.  ``permissive``: returns ``(points, rejects)``; rejects
    keep the input columns plus ``reason``.  Both are lazy and distributed.
    """
    _check_mode(mode)
    value = ref(col)
    x, y, ok, reason = _parsed(value)
    base = [ref(c) for c in df.columns] if keep_input else []
    if mode == "strict":
        # short lines are matched once and need no try_cast; the plain casts below see good lines only
        msg = F.concat(F.lit("bad point line ("), reason, F.lit("): "), F.coalesce(value, F.lit("NULL")))
        good = F.when(value.rlike(SHORT_LINE_PATTERN), F.lit(True)).when(ok, F.lit(True))
        checked = df.where(good.otherwise(F.raise_error(msg).cast("boolean")))
        first, last = (F.substring_index(value, " ", k).cast("bigint") for k in (1, -1))
        return checked.select(*base, first.alias("x"), last.alias("y"))
    own = [ref(c) for c in df.columns]
    tagged = df.select(*own, x.alias("_x"), y.alias("_y"), ok.alias("_ok"), reason.alias("_reason"))
    good = tagged.where(F.col("_ok")).select(*base, F.col("_x").alias("x"), F.col("_y").alias("y"))
    bad = tagged.where(~F.col("_ok")).select(*own, F.col("_reason").alias("reason"))
    return good, bad


def read_lines(spark: SparkSession, path: str | Sequence[str], origin: bool = True) -> DataFrame:
    """Text lines of files, directories, globs or compressed files.

    Columns: ``value``, the partition columns of the path (``g=1/part.txt``) and,
    with ``origin``, where the line was read: ``file`` and ``block_start``, the
    byte offset of the scan's block in that file (0 for unsplittable files).
    """
    text = spark.read.text([path] if isinstance(path, str) else list(path))
    if not origin:
        return text
    meta = F.col("_metadata")
    return text.select("*", meta["file_path"].alias("file"), meta["file_block_start"].alias("block_start"))


def read_points(
    spark: SparkSession, path: str | Sequence[str], mode: str = "strict", keep_text: bool = False,
    group_cols: Sequence[str] = (),
):
    """Read ``"x y"`` lines (files, directories, globs, compressed) as points.

    Returns the partition columns named in ``group_cols`` and ``x, y`` (plus
    ``value`` with ``keep_text``); in permissive mode a ``(points, rejects)``
    pair.  Rejects have the line, all partition columns, the file and block they
    come from, and the reason.
    """
    _check_mode(mode)
    kept = [ref(c) for c in ([*group_cols, "value"] if keep_text else group_cols)]
    if mode == "strict":
        parsed = parse_points(read_lines(spark, path, origin=False), "value", mode)
        return parsed.select(*kept, "x", "y")
    good, bad = parse_points(read_lines(spark, path), "value", mode)
    return good.select(*kept, "x", "y"), bad


def points_from(
    df: DataFrame,
    x: str,
    y: str,
    group_cols: Sequence[str] = (),
    mode: str = "strict",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Points from two numeric columns of any DataFrame: ``group cols..., x, y``.

    Values must be integers (an integral DOUBLE such as 17.0 is fine).  Strict
    mode fails on a NULL, fractional or out-of-range value; permissive mode
    returns ``(points, rejects)``, the rejects with all their columns.
    """
    _check_mode(mode)
    gcols = [ref(c) for c in group_cols]
    for c in (x, y):
        if not isinstance(df.schema[c].dataType, NumericType):
            raise ValueError(f"column {c!r} is not numeric; parse text with parse_points")
    xs, ys = ref(x), ref(y)
    xi, yi = xs.try_cast("bigint"), ys.try_cast("bigint")
    if mode == "permissive":
        good, bad = split_points(df, x, y)
        return good.select(*gcols, xi.alias("x"), yi.alias("y")), bad
    shown = [F.coalesce(c.cast("string"), F.lit("NULL")) for c in (xs, ys)]
    checked = require(df, _whole_point(xs, ys), F.concat(F.lit("not an integer point: "), shown[0], F.lit(" "), shown[1]))
    return checked.select(*gcols, xi.alias("x"), yi.alias("y"))


def _whole_point(x: Column, y: Column) -> Column:
    return F.coalesce((x.try_cast("bigint") == x) & (y.try_cast("bigint") == y), F.lit(False))


def split_points(df: DataFrame, x: str, y: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose two columns are integers in BIGINT range, the others), with all their columns."""
    ok = _whole_point(ref(x), ref(y))
    return df.where(ok), df.where(~ok)


def write_sets(lines: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """Sink for results (the reference collected a Python set on the driver).

    Writes one row per line, distributed; parquet keeps ``points`` as
    ``ARRAY<STRUCT<x,y>>``.  For text formats the points are flattened to
    ``'x y;x y'``.  :func:`colline.sources.sink.write_batch` is the sink that
    can be run again.
    """
    from colline.functions.geometry import points_text

    out = lines
    if fmt in ("csv", "text", "json") and "points" in lines.columns:
        out = lines.withColumn("points", points_text("points"))
    if fmt == "text":
        out = out.select(F.col("points").alias("value"))
    out.write.mode(mode).format(fmt).save(path)
