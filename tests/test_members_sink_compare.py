"""Paged lines, the sink that can be run again, comparison by fingerprints, file origins and column names."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from colline import (
    collinear_sets, group_pairs, line_members, ordered_pairs, page_points, paged_lines, points_from, process, read_batches,
    read_manifest, same_sets, set_difference_counts, set_differences, write_batch,
)
from colline.operators.compare import line_fingerprints, pair_fingerprints, set_fingerprints

from .conftest import GOLDEN9, POINTS9, POINTS40, as_sets, brute_force_lines, points_df

# ---- pages ------------------------------------------------------------------------------------


@pytest.mark.parametrize("sizing", [{}, {"broadcast_max_bytes": 0}, {"pairs_per_task": 20}, {"pairs_per_task": 20, "broadcast_max_bytes": 0}])
def test_members_and_pages_hold_the_lines(spark, sizing):
    big = [(x << 57, (y << 57) + 5) for x, y in POINTS40]
    for pts in (POINTS40, big):
        want = brute_force_lines(pts)
        members = line_members(points_df(spark, pts), **sizing)
        assert members.count() == sum(map(len, want))
        pages = paged_lines(points_df(spark, pts), page_size=3, **sizing).collect()
        lines: dict[tuple, dict] = {}
        for p in pages:
            lines.setdefault((p.ux, p.uy, p.c, p.n_points), {})[p.page] = [tuple(q) for q in p.points]
        for (_, _, _, n), by_page in lines.items():
            assert sorted(by_page) == list(range(-(-n // 3)))
            assert all(len(by_page[k]) == 3 for k in range(n // 3))
        assert {tuple(q for k in sorted(b) for q in b[k]) for b in lines.values()} == want


def test_pages_of_groups_with_null_and_few_points(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 2, 2), (None, 3, 3), ("a", 1, 1), ("a", 2, 2)], "`g.h` string, x long, y long")
    rows = paged_lines(df, "g.h", page_size=2).collect()
    assert [(r[0], r.n_points, r.page, len(r.points)) for r in sorted(rows, key=lambda r: r.page)] == [(None, 3, 0, 2), (None, 3, 1, 1)]
    assert paged_lines(df.where("x > 9"), "g.h").count() == 0
    with pytest.raises(ValueError):
        page_points(line_members(df, "g.h"), "g.h", page_size=0)


def test_a_line_of_a_million_points_is_in_no_single_task(spark):
    """Ranges of one line are of even size, and a page is its rank's slice."""
    n, size = 1_000_000, 10_000
    line = spark.range(n).select(F.lit(1).cast("long").alias("ux"), F.lit(2).cast("long").alias("uy"), F.lit(0).cast("decimal(38,0)").alias("c"),
                                 ((F.col("id") * 7919) % n).alias("x"), ((F.col("id") * 7919) % n * 2).alias("y"))
    pages = page_points(line, page_size=size)
    ranges = line.repartitionByRange("ux", "uy", "c", "x", "y").groupBy(F.spark_partition_id()).count().collect()
    assert len(ranges) >= 4 and max(r["count"] for r in ranges) < n / 2
    got = pages.select("page", "n_points", F.size("points").alias("k"), F.col("points")[0]["x"].alias("low"), F.element_at("points", -1)["x"].alias("high")).collect()
    assert sorted(tuple(r) for r in got) == [(p, n, size, p * size, (p + 1) * size - 1) for p in range(n // size)]


# ---- sink -------------------------------------------------------------------------------------


def test_a_batch_written_again_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "sets")
    lines = collinear_sets(points_df(spark, POINTS9))
    write_batch(lines, path, "a")
    write_batch(lines.where("n_points > 3"), path, "b=1/x y")
    write_batch(lines, path, "a")
    assert as_sets(read_batches(spark, path, "a")) == GOLDEN9 and read_batches(spark, path, "a").count() == 3
    assert read_batches(spark, path).count() == 4
    assert sorted((r.batch, r.rows, r.points) for r in read_manifest(spark, path).collect()) == [("a", 3, 10), ("b=1/x y", 1, 4)]
    write_batch(lines.where("n_points > 99"), path, "a")  # nothing is left of the batch
    assert read_batches(spark, path).count() == 1
    with pytest.raises(ValueError, match="no such"):
        read_batches(spark, path, "a")


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "sets")
    lines = collinear_sets(points_df(spark, POINTS9))
    write_batch(lines, path, "a")
    fails = F.when(F.col("n_points") > 3, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("n_points"))
    with pytest.raises(Exception, match="lost"):
        write_batch(lines.withColumn("n_points", fails), path, "a")
    assert as_sets(read_batches(spark, path)) == GOLDEN9


def test_a_write_between_its_steps_is_noticed(spark, tmp_path):
    path = str(tmp_path / "sets")
    lines = collinear_sets(points_df(spark, POINTS9))
    write_batch(lines, path, "a")
    lines.limit(1).withColumn("batch", F.lit("new")).write.mode("append").partitionBy("batch").parquet(path)
    assert read_batches(spark, path).count() == 3  # files without a manifest row
    lines.limit(1).withColumn("batch", F.lit("a")).write.mode("append").partitionBy("batch").parquet(path)
    with pytest.raises(ValueError, match="differ"):
        read_batches(spark, path)
    for name in ("", None):
        with pytest.raises(ValueError):
            write_batch(lines, path, name)


# ---- comparison -------------------------------------------------------------------------------


def test_fingerprints_of_three_origins_agree(spark):
    for pts in (POINTS40, [(x << 58, y << 58) for x, y in POINTS9]):
        df = spark.createDataFrame([(g, x, y) for g in (1, None) for x, y in pts], "g int, x long, y long")
        lines = collinear_sets(df, "g")
        bag = lambda d: sorted(map(tuple, d.distinct().collect()), key=repr)
        want = bag(set_fingerprints(lines, "points", "g"))
        assert bag(line_fingerprints(df, "g")) == want and len(want) == 2 * len(brute_force_lines(pts))
        pairs = ordered_pairs(df, "g")
        assert bag(pair_fingerprints(pairs, "g")) == want == bag(set_fingerprints(group_pairs(pairs, "g"), "points", "g"))


def test_damaged_sides_are_found(spark):
    lines = collinear_sets(points_df(spark, POINTS40))
    n = lines.count()
    assert same_sets(lines, lines.withColumn("points", F.reverse("points")))
    first = lines.orderBy("ux", "uy", "c").limit(1)
    rest = lines.join(first.select("ux", "uy", "c"), ["ux", "uy", "c"], "left_anti")
    bent = F.transform("points", lambda p: F.when(p["x"] == F.col("points")[0]["x"], F.struct(p["x"].alias("x"), (p["y"] + 1000).alias("y"))).otherwise(p))
    damaged = rest.select("points").unionAll(first.select(bent.alias("points")))
    assert not same_sets(lines, damaged)
    assert set_difference_counts(lines, damaged).first().asDict() == {"n_left": n, "n_right": n, "n_only_left": 1, "n_only_right": 1}
    found = {r.side: [tuple(p) for p in r.points] for r in set_differences(lines, damaged).collect()}
    assert found["left"] == [tuple(p) for p in first.first().points] and found["right"] != found["left"] and len(found) == 2


def test_comparison_by_group_shuffles_no_array(spark):
    df = spark.createDataFrame([(1, POINTS9[:3]), (2, POINTS9[:3]), (None, [])], "g int, points array<struct<x:long,y:long>>")
    swapped = df.withColumn("g", 3 - F.col("g"))
    assert same_sets(df, swapped, group_cols="g")
    assert set_difference_counts(df, df.where("g = 1"), group_cols="g").first().n_only_left == 2
    counts = set_difference_counts(df, swapped)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert not any(re.search("(?<!n_)points#|_set#", line) for line in plan.splitlines() if "Exchange" in line)


# ---- files and names ----------------------------------------------------------------------------


def test_rejects_name_their_file_and_partition(spark, tmp_path):
    for g, lines in ((1, ["1 1", "2 2", "bad", "3 3"]), (2, ["0 0", "1  1", ""])):
        os.makedirs(tmp_path / f"g={g}")
        (tmp_path / f"g={g}" / "part.txt").write_text("\n".join(lines) + "\n")
    sets, rejects = process(spark, str(tmp_path), "permissive", group_cols="g")
    assert as_sets(sets) == {((1, 1), (2, 2), (3, 3))} and sets.first().g == 1
    got = sorted((r.g, r.value, r.file.split("/")[-2], r.block_start) for r in rejects.collect())
    assert got == [(1, "bad", "g=1", 0), (2, "", "g=2", 0), (2, "1  1", "g=2", 0)]


def test_groups_of_any_name(spark):
    df = spark.createDataFrame([(k, i, i) for k in (1, 2) for i in range(4)], "k int, a long, b long")
    for name in ("x", "g.h", "ax", "a`b", "points "):
        named = df.withColumnRenamed("k", name)
        for mode in ("strict", "permissive"):
            out = collinear_sets(named, name, "a", "b", mode=mode)
            out = out if mode == "strict" else out[0]
            assert out.columns[0] == name and sorted(r[0] for r in out.collect()) == [1, 2]
    for name in ("points", "ux", "n_points"):
        with pytest.raises(ValueError, match="output columns"):
            collinear_sets(df.withColumnRenamed("k", name), name, "a", "b")
    good, bad = points_from(df, "a", "b", ["k"], "permissive")
    assert good.columns == ["k", "x", "y"] and bad.count() == 0
