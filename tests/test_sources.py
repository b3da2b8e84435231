"""Text and column sources (S1, P1, Q10, Q11) and the sink (S3)."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from colline.plans.process import build_collinear_set, process
from colline.sources import storage
from colline.sources.text import parse_points, points_from, read_points, write_sets

from .conftest import GOLDEN9, POINTS9, as_sets

BAD_LINES = ["", "1  2", "1 2 ", "1", "1 2 3", "1.5 2", "a b", " 1 2", "99999999999999999999 1"]


def test_parse_examples_f6(spark):
    df = spark.createDataFrame([("1 1",), ("2 3",), ("-4 +5",)], "value string")
    rows = parse_points(df).select("x", "y").collect()
    assert [tuple(r) for r in rows] == [(1, 1), (2, 3), (-4, 5)]
    assert dict(parse_points(df).dtypes)["x"] == "bigint"


@pytest.mark.parametrize("line", BAD_LINES)
def test_strict_fails_on_bad_line(spark, line):
    df = spark.createDataFrame([("1 2",), (line,)], "value string")
    with pytest.raises(Exception, match="bad point line"):
        parse_points(df, mode="strict").collect()


def test_permissive_quarantines(spark):
    df = spark.createDataFrame([("1 2",)] + [(b,) for b in BAD_LINES] + [(None,)], "value string")
    good, bad = parse_points(df, mode="permissive")
    assert [tuple(r) for r in good.select("x", "y").collect()] == [(1, 2)]
    rejected = bad.collect()
    assert len(rejected) == len(BAD_LINES) + 1
    assert all(r["reason"] for r in rejected)


def test_read_points_files_and_process(spark, tmp_path):
    d = tmp_path / "pts"
    d.mkdir()
    (d / "a.txt").write_text("\n".join(f"{x} {y}" for x, y in POINTS9[:5]) + "\n")
    (d / "b.txt").write_text("\n".join(f"{x} {y}" for x, y in POINTS9[5:]) + "\n")
    pts = read_points(spark, str(d))
    assert pts.count() == 9
    assert as_sets(process(spark, str(d))) == GOLDEN9


def test_process_permissive_skips_bad_lines(spark, tmp_path):
    f = tmp_path / "points.txt"
    f.write_text("\n".join([f"{x} {y}" for x, y in POINTS9] + ["oops", "1 2 3"]) + "\n")
    with pytest.raises(Exception):
        process(spark, str(f)).collect()
    sets, rejects = process(spark, str(f), mode="permissive")
    assert as_sets(sets) == GOLDEN9
    assert sorted(r["value"] for r in rejects.collect()) == ["1 2 3", "oops"]


def test_process_by_partition_column(spark, tmp_path):
    for g in (1, 2):
        (tmp_path / f"g={g}").mkdir()
        (tmp_path / f"g={g}" / "p.txt").write_text("\n".join(f"{x} {y}" for x, y in POINTS9) + "\n")
    out = process(spark, str(tmp_path), group_cols="g")
    assert {r["g"] for r in out.collect()} == {1, 2} and out.count() == 6


def test_build_collinear_set_groups_and_rejects(spark):
    rows = [(g, f"{x} {y}") for g in (1, 2) for x, y in POINTS9] + [(1, "oops")]
    sets, rejects = build_collinear_set(spark.createDataFrame(rows, "g int, value string"), mode="permissive", group_cols="g")
    assert sets.count() == 20 and rejects.count() == 1


def test_strict_checks_survive_column_pruning(spark):
    with pytest.raises(Exception, match="bad point line"):
        parse_points(spark.createDataFrame([("1 2",), ("oops",)], "value string")).count()
    with pytest.raises(Exception, match="not an integer point"):
        points_from(spark.createDataFrame([(1.5, 2.0)], "a double, b double"), "a", "b").count()
    with pytest.raises(ValueError, match="not numeric"):
        points_from(spark.createDataFrame([("1", 2)], "a string, b int"), "a", "b")


@pytest.mark.parametrize("bad", [(1.5, 1.0), (None, 1.0), (float("nan"), 1.0), (1e30, 1.0)])
def test_line_search_rejects_what_is_no_point(spark, bad):
    from colline.operators.lines import collinear_sets

    df = spark.createDataFrame([(0.0, 0.0), (2.0, 2.0), (4.0, 4.0), bad], "x double, y double")
    with pytest.raises(Exception, match="not an integer point"):
        collinear_sets(df).collect()
    lines, rejects = collinear_sets(df, mode="permissive")
    assert as_sets(lines) == {((0, 0), (2, 2), (4, 4))} and rejects.count() == 1


def test_build_collinear_set_multiset(spark):
    text = spark.createDataFrame([(f"{x} {y}",) for x, y in POINTS9], "value string")
    rows = build_collinear_set(text).collect()
    assert len(rows) == 10  # each k-point set k times (Q1)
    assert {tuple((p["x"], p["y"]) for p in r["points"]) for r in rows} == GOLDEN9


def test_points_from_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (3, 4.0, "b")], "a int, b double, g string")
    assert [tuple(r) for r in points_from(df, "a", "b", ["g"]).collect()] == [("a", 1, 2), ("b", 3, 4)]
    bad = spark.createDataFrame([(1, 2.5)], "a int, b double")
    with pytest.raises(Exception, match="not an integer point"):
        points_from(bad, "a", "b").collect()
    good, rej = points_from(bad.union(df.select("a", "b")), "a", "b", mode="permissive")
    assert good.count() == 2 and rej.count() == 1


def test_write_sets(spark, tmp_path):
    from colline.operators.lines import collinear_sets

    lines = collinear_sets(spark.createDataFrame(POINTS9, "x long, y long"))
    write_sets(lines, str(tmp_path / "pq"))
    back = spark.read.parquet(str(tmp_path / "pq"))
    assert as_sets(back) == GOLDEN9
    write_sets(lines, str(tmp_path / "csv"), fmt="csv")
    txt = {r[0] for r in spark.read.csv(str(tmp_path / "csv")).select(F.col("_c4")).collect()}
    assert "0 1;3 4;5 6" in txt


def test_read_points_gzip_and_glob(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "p1.txt.gz", "wt") as fh:
        fh.write("\n".join(f"{x} {y}" for x, y in POINTS9) + "\n")
    (tmp_path / "p2.txt").write_text("7 7\n")
    pts = read_points(spark, str(tmp_path / "p*"))
    assert pts.count() == 10
    assert as_sets(process(spark, str(tmp_path / "p1.txt.gz"))) == GOLDEN9


def test_release_leaves_older_and_kept_tables(spark):
    old = storage.materialize_always(spark.range(3), "old")
    mark = storage.written(spark)
    gone = storage.materialize_always(spark.range(4), "gone")
    kept = storage.materialize_always(spark.range(5), "kept")
    path = kept.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert storage.release(spark, mark, keep=[path]) == 1
    assert old.count() == 3 and kept.count() == 5 and storage.written(spark) == mark + 1
    assert not os.path.exists(gone.inputFiles()[0].removeprefix("file://"))
    assert storage.release(spark, mark) == 1 and storage.written(spark) == mark
