"""The search by direction: equal to brute force and to the search by pairs, and chosen for dense sets only."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest

from colline import collinear_sets, rich_lines
from colline.operators.lines import prepare, swept
from colline.operators.sweep import CONF_SWEEP_MIN_PAIRS, SWEEP_MIN_PAIRS, _Grid, sweeps
from colline.operators.workload import PairWorkload
from colline.plans.oracle import ORACLE_SQL
from colline.plans.tables import QUERIES
from tests.conftest import as_sets, brute_force_lines, points_df


@pytest.fixture()
def always(spark):
    """Small sets are swept too."""
    spark.conf.set(CONF_SWEEP_MIN_PAIRS, "1")
    yield
    spark.conf.unset(CONF_SWEEP_MIN_PAIRS)


def _random(w, h, share, seed, x0=0, y0=0):
    rnd = random.Random(seed)
    return [(x0 + x, y0 + y) for x in range(w) for y in range(h) if rnd.random() < share]


BOXES = [(7, 12, 0.7), (12, 7, 0.7), (1, 9, 1.0), (9, 1, 1.0), (8, 8, 1.0), (3, 40, 0.5), (40, 3, 0.5), (5, 300, 0.2)]


@pytest.mark.parametrize("k", [3, 4, 6])
def test_every_direction_of_a_grid_is_read_off(k):
    for seed, (w, h, share) in enumerate(BOXES):
        pts = _random(w, h, share, seed)
        grid = _Grid(*(np.array(c) for c in zip(*pts)))
        found = list(grid.straight(k))
        for slot in range(3):
            for a, b, back in zip(*(v.tolist() for v in grid.directions(k, slot, 3))):
                found += list(grid.lines(a, b, back, k))
        got = []
        for sizes, x, y in found:
            ends = np.cumsum(sizes)
            both = list(zip((x + grid.x0).tolist(), (y + grid.y0).tolist()))
            got += [tuple(both[e - n : e]) for e, n in zip(ends, sizes)]
        assert len(got) == len(set(got)) and set(got) == brute_force_lines(pts, k), (w, h)


def test_swept_lines_equal_those_of_pairs(spark, always):
    """every pair was formed, of 25 columns of balances too."""
    for pts in (_random(9, 30, 0.6, 1, -4, -1000), _random(30, 9, 0.6, 2, 10**6, 7)):
        df = points_df(spark, pts + pts[:5])
        prep = prepare(df, None, "x", "y")
        assert swept(prep, 3, prep.plan.n_points**2) is not None
        rows = {tuple(r) for r in collinear_sets(df, text=True).collect()}
        assert as_sets(collinear_sets(df)) == brute_force_lines(pts)
        assert as_sets(rich_lines(df, 5)) == brute_force_lines(pts, 5)
        assert {r["points"] for r in rich_lines(df, 5, text=True).collect()} == {r[4] for r in rows if r[3] >= 5}
        spark.conf.set(CONF_SWEEP_MIN_PAIRS, str(SWEEP_MIN_PAIRS))
        assert {tuple(r) for r in collinear_sets(df, text=True).collect()} == rows
        spark.conf.set(CONF_SWEEP_MIN_PAIRS, "1")


def test_schemas_do_not_depend_on_the_search(spark, always):
    df = points_df(spark, _random(8, 20, 0.6, 3))
    by_sweep = [f(df, text=t).dtypes for f in (collinear_sets, lambda d, text: rich_lines(d, 5, text=text)) for t in (False, True)]
    spark.conf.set(CONF_SWEEP_MIN_PAIRS, str(SWEEP_MIN_PAIRS))
    assert by_sweep == [f(df, text=t).dtypes for f in (collinear_sets, lambda d, text: rich_lines(d, 5, text=text)) for t in (False, True)]


def _plan(n, w, h):
    return PairWorkload(n, 1, n * (n - 1) // 2, n, h, 0, 1, 1, 1, 1, False, True, 1, w, h)


def test_dense_sets_are_swept_and_others_are_not(spark):
    dense, sparse, far = _plan(260_000, 25, 11_000), _plan(260_000, 10**5, 10**5), _plan(260_000, 25, 10**9)
    assert all(sweeps(spark, dense, k, dense.n_points**2) for k in (3, 12))
    assert not any(sweeps(spark, p, k, p.n_points**2) for p in (sparse, far) for k in (3, 12))
    assert not sweeps(spark, _plan(100, 10, 10), 3, 100**2)


@pytest.mark.parametrize("name", ["lines_customer", "lines_rich_customer", "lines_supplier"])
def test_queries_of_a_dense_table_match_their_sql(spark, always, tmp_path, name):
    pts = _random(25, 40, 0.8, 4, 0, -10)
    for table, key in (("customer", "c"), ("supplier", "s")):
        rows = [(i, x, y + d) for i, (x, y) in enumerate(pts) for d in (0.25, -0.25)]
        spark.createDataFrame(rows, f"{key}_custkey long, {key}_nationkey int, {key}_acctbal double").write.parquet(str(tmp_path / f"{table}.parquet"))
    got = QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    for table in ("customer", "supplier"):
        con.sql(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
    want = con.sql(ORACLE_SQL[name])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted((*r[:2], r[2], *r[3:]) for r in want.fetchall())
