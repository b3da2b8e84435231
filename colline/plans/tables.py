"""Queries over the benchmark tables, one per operator, with flat output columns.

Every query reads whole tables; point lists are rendered as ``'x y;x y;...'``
text (sorted x, then y) so that results compare across engines.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colline.functions.geometry import points_text
from colline.operators.anchors import anchor_groups, collinear_sets_by_anchor, format_groups, group_pairs
from colline.operators.compare import fingerprint_difference_counts, line_fingerprints, pair_fingerprints, set_differences
from colline.operators.incidence import extend_lines, line_sets, lines_through, points_on_lines, rich_lines
from colline.operators.lines import collinear_sets, line_params
from colline.operators.members import paged_lines
from colline.operators.pairs import cartesian, ordered_pairs, with_slope
from colline.operators.wide import parse_wide_points, wide_collinear_sets
from colline.plans.process import build_collinear_set, process
from colline.sources.sink import read_batches, read_manifest, write_batch
from colline.sources.storage import materialize_always, new_path
from colline.sources.text import parse_points, points_from


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- point sets drawn from the tables -------------------------------------------------


def supplier_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nation, account balance rounded to a whole unit) of every supplier."""
    s = table(spark, sf_dir, "supplier")
    return points_from(s.select("s_nationkey", F.round("s_acctbal").alias("bal")), "s_nationkey", "bal")


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nation, account balance rounded to a whole unit) of every customer."""
    c = table(spark, sf_dir, "customer")
    return points_from(c.select("c_nationkey", F.round("c_acctbal").alias("bal")), "c_nationkey", "bal")


def lineitem_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line number, quantity) of every line item."""
    return points_from(table(spark, sf_dir, "lineitem"), "l_linenumber", "l_quantity")


def lineitem_by(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """(line number, quantity) of every line item with a group column."""
    return points_from(table(spark, sf_dir, "lineitem"), "l_linenumber", "l_quantity", group_cols=[key])


def _flat(lines: DataFrame) -> DataFrame:
    return lines.withColumn("points", points_text("points"))


# ---- registered queries ---------------------------------------------------------------


def q_parse_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``"x y"`` text built from line items, parsed back strictly."""
    li = table(spark, sf_dir, "lineitem")
    text = li.select(
        F.concat(F.col("l_linenumber").cast("string"), F.lit(" "), F.col("l_quantity").cast("bigint").cast("string"))
        .alias("value")
    )
    return parse_points(text, "value", "strict")


def q_parse_points_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 permissive: quantities of odd line numbers are written as decimals
    (``"3 17.0"``), which are not integer points and are quarantined."""
    li = table(spark, sf_dir, "lineitem")
    qty = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity").cast("bigint").cast("string")).otherwise(
        F.col("l_quantity").cast("string")
    )
    text = li.select(F.concat(F.col("l_linenumber").cast("string"), F.lit(" "), qty).alias("value"))
    good, bad = parse_points(text, "value", "permissive")
    return good.select("value", "x", "y", F.lit(True).alias("accepted")).unionByName(
        bad.select("value", F.lit(None).cast("bigint").alias("x"), F.lit(None).cast("bigint").alias("y"),
                   F.lit(False).alias("accepted"))
    )


def q_cartesian_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bare product of each order's (line number, quantity) rows."""
    return cartesian(lineitem_by(spark, sf_dir, "l_orderkey"), "l_orderkey")


def q_ordered_pairs_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered pairs of distinct points within each order."""
    return ordered_pairs(lineitem_by(spark, sf_dir, "l_orderkey"), "l_orderkey")


def q_pair_slopes_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slope of every ordered pair within each order."""
    return with_slope(ordered_pairs(lineitem_by(spark, sf_dir, "l_orderkey"), "l_orderkey"))


def q_lines_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collinear_sets(supplier_points(spark, sf_dir), text=True)


def q_lines_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One large group (every customer): exercises the bucket-split layout."""
    return collinear_sets(customer_points(spark, sf_dir), text=True)


def q_lines_lineitem_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(collinear_sets(lineitem_grid(spark, sf_dir)))


def q_lines_per_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(collinear_sets(lineitem_by(spark, sf_dir, "l_partkey"), "l_partkey"))


def q_lines_per_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(collinear_sets(lineitem_by(spark, sf_dir, "l_suppkey"), "l_suppkey"))


# Fixed map of the plane that keeps lines but makes coordinates and directions large.
LARGE_MAP = ((8589934593, 4294967311), (4294967291, -8589934609))


def q_lines_large_per_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of large coordinates: directions beyond 2^26 and line constants beyond BIGINT."""
    pts = lineitem_by(spark, sf_dir, "l_partkey")
    x, y = (F.col("x") * F.lit(a) + F.col("y") * F.lit(b) for a, b in LARGE_MAP)
    return _flat(collinear_sets(pts.select("l_partkey", x.alias("x"), y.alias("y")), "l_partkey"))


# Fixed linear map to coordinates beyond BIGINT, odd rows and no common factors.
WIDE_MAP = ((1208925819614629174706189, 604462909807314587353111), (604462909807314587353087, -1208925819614629174706201))


def q_lines_wide_per_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of integers of up to 27 digits, parsed, and their lines per part."""
    pts = lineitem_by(spark, sf_dir, "l_partkey")
    x, y = (F.col("x") * F.lit(Decimal(a)) + F.col("y") * F.lit(Decimal(b)) for a, b in WIDE_MAP)
    text = pts.select("l_partkey", F.concat_ws(" ", x.cast("string"), y.cast("string")).alias("value"))
    return _flat(wide_collinear_sets(parse_wide_points(text), "l_partkey"))


def q_line_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(line_params(collinear_sets(lineitem_by(spark, sf_dir, "l_partkey"), "l_partkey")))


def q_anchor_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(anchor_groups(lineitem_by(spark, sf_dir, "l_partkey"), "l_partkey"))


def q_format_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(format_groups(anchor_groups(lineitem_by(spark, sf_dir, "l_partkey"), "l_partkey")))


def q_sets_by_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(collinear_sets_by_anchor(lineitem_by(spark, sf_dir, "l_partkey"), "l_partkey"))


def q_groups_from_pairs_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/A4: ready-made ordered pairs grouped by (anchor, slope) within each order."""
    return _flat(group_pairs(ordered_pairs(lineitem_by(spark, sf_dir, "l_orderkey"), "l_orderkey"), "l_orderkey"))


def q_sets_from_text_per_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``"x y"`` text of the line items, parsed and searched per part, k copies per line."""
    text = table(spark, sf_dir, "lineitem").select(
        "l_partkey",
        F.concat(F.col("l_linenumber").cast("string"), F.lit(" "), F.col("l_quantity").cast("bigint").cast("string")).alias("value"),
    )
    return _flat(build_collinear_set(text, group_cols="l_partkey"))


def q_points_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as points without rounding: whole balances are points, the others are rejected."""
    good, bad = points_from(table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", ["c_custkey"], "permissive")
    none = F.lit(None).cast("bigint")
    return good.select("c_custkey", "x", "y", F.lit(True).alias("accepted")).unionAll(
        bad.select("c_custkey", none.alias("x"), none.alias("y"), F.lit(False).alias("accepted"))
    )


def q_same_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets from ordered pairs grouped by (anchor, slope) against those of the line search.

    The two sides share nothing but the points.
    """
    pts = materialize_always(lineitem_by(spark, sf_dir, "l_partkey").distinct(), "points")
    left = pair_fingerprints(ordered_pairs(pts, "l_partkey"), "l_partkey")
    return fingerprint_difference_counts(left, line_fingerprints(pts, "l_partkey"), "l_partkey")


def q_set_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 with answers: the sets of all line items against those without line number 4, per part."""
    pts = lineitem_by(spark, sf_dir, "l_partkey")
    full = collinear_sets(pts, "l_partkey")
    less = collinear_sets(pts.where("x <> 4"), "l_partkey")
    return _flat(set_differences(full, less, group_cols="l_partkey"))


def _order_split(spark: SparkSession, sf_dir: str, chosen: str) -> tuple[DataFrame, DataFrame]:
    """Points of the line items per part: those of the orders ``chosen``, and the others."""
    pts = points_from(table(spark, sf_dir, "lineitem"), "l_linenumber", "l_quantity", group_cols=["l_partkey", "l_orderkey"])
    cols = ["l_partkey", "x", "y"]
    return pts.where(chosen).select(*cols), pts.where(f"not ({chosen})").select(*cols)


def q_points_on_lines_per_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the odd orders' points, with the points of all orders on them, per part."""
    odd, even = _order_split(spark, sf_dir, "l_orderkey % 2 = 1")
    members = points_on_lines(odd.unionAll(even), collinear_sets(odd, "l_partkey"), "l_partkey")
    return _flat(line_sets(members, "l_partkey"))


def q_third_points_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 from given pairs: for every ordered pair of an order, all points of the order on its line."""
    pts = lineitem_by(spark, sf_dir, "l_orderkey")
    lines = lines_through(ordered_pairs(pts, "l_orderkey"), "l_orderkey")
    return points_on_lines(pts, lines, "l_orderkey")


def q_lines_rich_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 for lines of twelve points or more, by the pigeonhole search."""
    return rich_lines(customer_points(spark, sf_dir), 12, text=True)


def q_extend_lines_per_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3/A5 kept up to date: the lines without the orders divisible by 7, then with these added, per part."""
    new, old = _order_split(spark, sf_dir, "l_orderkey % 7 = 0")
    return _flat(extend_lines(collinear_sets(old, "l_partkey"), old, new, "l_partkey"))


def q_lines_paged_per_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1/A4/A5 with bounded rows: the lines of each supplier in pages of eight points."""
    return _flat(paged_lines(lineitem_by(spark, sf_dir, "l_suppkey"), "l_suppkey", page_size=8))


# Columns of lineitem whose values name the folders of the text files.
FILE_GROUPS = ["l_returnflag", "l_linestatus"]


def _point_files(spark: SparkSession, sf_dir: str) -> str:
    """Write every line item as a text line into folders by flag and status; orders
    divisible by 50 as ``"3 17.0"``, which is no integer point.  Returns the folder."""
    li = table(spark, sf_dir, "lineitem")
    whole = F.col("l_quantity").cast("bigint").cast("string")
    odd = F.concat(whole, F.lit(".0"))
    text = F.concat(F.col("l_linenumber").cast("string"), F.lit(" "), F.when(F.col("l_orderkey") % 50 == 0, odd).otherwise(whole))
    path = new_path(spark, "point-files")
    li.select(*FILE_GROUPS, text.alias("value")).write.partitionBy(*FILE_GROUPS).text(path)
    return path


def q_process_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files in partition folders to sets per folder, bad lines set aside."""
    sets, _ = process(spark, _point_files(spark, sf_dir), "permissive", group_cols=FILE_GROUPS)
    return _flat(sets)


def q_process_file_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines set aside, with their folder, reason and whether they name a file of that folder."""
    _, bad = process(spark, _point_files(spark, sf_dir), "permissive", group_cols=FILE_GROUPS)
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.replace(F.col(c), F.lit(" "), F.lit("%20"))) for c in FILE_GROUPS])
    named = F.contains(F.col("file"), folder) & F.col("block_start").isNotNull()
    return bad.groupBy(*FILE_GROUPS, "value", "reason", named.alias("names_its_file")).agg(F.count(F.lit(1)).alias("n"))


def q_write_sets_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the lines per part written as two batches, one of them twice, and read back with the manifest."""
    path = new_path(spark, "set-batches")
    lines = collinear_sets(lineitem_by(spark, sf_dir, "l_partkey"), "l_partkey")
    for batch in ("odd", "even", "odd"):
        write_batch(lines.where(F.col("l_partkey") % 2 == (1 if batch == "odd" else 0)), path, batch)
    listed = read_manifest(spark, path).select("batch", F.col("rows").alias("batch_rows"), F.col("points").alias("batch_points"))
    return _flat(read_batches(spark, path)).join(listed, "batch")


QUERIES = {
    "parse_points": q_parse_points,
    "parse_points_permissive": q_parse_points_permissive,
    "cartesian_per_order": q_cartesian_per_order,
    "ordered_pairs_per_order": q_ordered_pairs_per_order,
    "pair_slopes_per_order": q_pair_slopes_per_order,
    "anchor_groups": q_anchor_groups,
    "format_groups": q_format_groups,
    "sets_by_anchor": q_sets_by_anchor,
    "lines_supplier": q_lines_supplier,
    "lines_customer": q_lines_customer,
    "lines_lineitem_grid": q_lines_lineitem_grid,
    "lines_per_part": q_lines_per_part,
    "lines_per_supplier": q_lines_per_supplier,
    "lines_large_per_part": q_lines_large_per_part,
    "lines_wide_per_part": q_lines_wide_per_part,
    "line_params": q_line_params,
    "groups_from_pairs_per_order": q_groups_from_pairs_per_order,
    "sets_from_text_per_part": q_sets_from_text_per_part,
    "points_quarantine": q_points_quarantine,
    "same_sets": q_same_sets,
    "set_differences": q_set_differences,
    "points_on_lines_per_part": q_points_on_lines_per_part,
    "third_points_per_order": q_third_points_per_order,
    "lines_rich_customer": q_lines_rich_customer,
    "extend_lines_per_part": q_extend_lines_per_part,
    "lines_paged_per_supplier": q_lines_paged_per_supplier,
    "process_files": q_process_files,
    "process_file_rejects": q_process_file_rejects,
    "write_sets_roundtrip": q_write_sets_roundtrip,
}
