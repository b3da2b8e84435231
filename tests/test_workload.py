"""The sizing job: task count, hot groups, replication bound, broadcast check."""

from __future__ import annotations

from colline.operators import workload as W
from colline.operators.lines import prepare

from .conftest import POINTS9


def _prep(spark, rows, group=True, **kw):
    schema = "g int, x long, y long" if group else "x long, y long"
    df = spark.createDataFrame(rows, schema)
    return prepare(df, "g" if group else None, "x", "y", **kw)


def test_empty_input(spark):
    prep = _prep(spark, [], group=False)
    assert prep.plan.n_points == 0 and prep.plan.total_pairs == 0 and prep.plan.partitions == 1


def test_counts_and_range(spark):
    rows = [(1, x, y) for x, y in POINTS9] + [(2, 100, -7), (2, 1, 1)]
    plan = _prep(spark, rows).plan
    assert plan.n_points == 11 and plan.n_groups == 2 and plan.max_group == 9
    assert plan.total_pairs == 36 + 1
    assert plan.max_abs == 100
    assert plan.null_key_groups == 0


def test_hot_groups_are_fewer_than_partitions(spark):
    rows = [(g, x, y) for g in range(5) for x in range(12) for y in range(g + 1)]
    prep = _prep(spark, rows, pairs_per_task=200)
    hot = W.hot_group_buckets(prep.sizes, prep.keys, prep.plan).collect()
    assert 0 < len(hot) < prep.plan.partitions
    for r in hot:
        n = 12 * (r["_g0"] + 1)
        assert 1 <= r["_s"] <= max(1, n // W.BUCKET_REPLICATION_DIVISOR)


def test_partition_cap(spark, monkeypatch):
    monkeypatch.setattr(W, "MAX_PARTITIONS", 3)
    rows = [(0, x, y) for x in range(20) for y in range(20)]
    plan = _prep(spark, rows, pairs_per_task=10).plan
    assert plan.partitions <= max(3, 2 * W.parallelism(spark))


def test_broadcast_is_size_checked(spark):
    rows = [(1, x, y) for x, y in POINTS9]
    assert _prep(spark, rows).plan.broadcast
    assert not _prep(spark, rows, broadcast_max_bytes=100).plan.broadcast
    assert not _prep(spark, POINTS9, group=False).plan.broadcast  # never without a group key


def test_null_group_keys_switch_to_struct_key(spark):
    prep = _prep(spark, [(None, x, y) for x, y in POINTS9])
    assert prep.plan.null_key_groups == 1 and prep.keys == ["_gk"]
