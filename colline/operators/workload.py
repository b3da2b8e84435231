"""Sizing of the pair stage: how many tasks, which groups to split, broadcast or not.

The pair stage costs n(n-1)/2 comparisons per group of n distinct points, so its
cost is quadratic in the group size while its *input* is linear.  Spark's own
sizing (AQE coalescing, skew-join detection) looks at bytes, which says nothing
about that blow-up: a 5 MB group of 300,000 points is 4.5e10 comparisons.  This
module measures the real workload with one small aggregate (one row per group,
combined map-side, then reduced to a single row on the driver) and derives:

* ``partitions``: enough tasks that each does at most ``pairs_per_task`` pairs
  (up to ``MAX_PARTITIONS`` tasks), and at least two tasks per core when there
  is work;
* hot groups: a group with more than ``pairs_per_task`` pairs is split by anchor;
  within the broadcast bound every anchor meets a broadcast copy of the group's
  points, beyond it the anchors go to ``S`` buckets that each get a copy.  The table
  of hot groups has fewer rows than ``partitions`` (each hot group carries more
  than total/partitions pairs), so broadcasting it is safe;
* ``broadcast``: the distinct points are broadcast to the anchor tasks only when
  their measured size (rows times key and coordinate bytes) is within
  ``broadcast_max_bytes``; ``split_broadcast`` is the same for the points of the
  hot groups alone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# Defaults; every one can be overridden per call or through the session conf
# keys below.
# About 1M pairs per task keeps each task's (anchor, direction) hash map small
# enough to stay cache-friendly (measured: 20M pairs per task ran the pair
# stage about 1.4x slower per pair).  Beyond MAX_PARTITIONS tasks the budget per
# task grows instead, so a huge input does not turn into millions of tiny
# tasks and shuffle blocks.
PAIRS_PER_TASK = 1_000_000
MIN_PAIRS_PER_TASK = 50_000
MAX_PARTITIONS = 100_000
BROADCAST_MAX_BYTES = 64 << 20
# Bytes of a point in a broadcast relation besides its key: packed coordinates and row overhead.
POINT_BYTES = 32
# Beyond the broadcast bound a split group of n points copies its points once per
# bucket: n * S rows.  S is at most SPLIT_BUCKETS_PER_CORE times the cores, so
# the copies grow with n, not with n^2 (the aggregate of a bucket spills).
SPLIT_BUCKETS_PER_CORE = 4
BUCKET_REPLICATION_DIVISOR = 16

CONF_PAIRS_PER_TASK = "colline.pairsPerTask"
CONF_MIN_PAIRS_PER_TASK = "colline.minPairsPerTask"
CONF_BROADCAST_MAX_BYTES = "colline.broadcastMaxBytes"


@dataclass(frozen=True)
class PairWorkload:
    n_points: int
    n_groups: int
    total_pairs: int
    max_group: int
    max_abs: int
    null_key_groups: int
    partitions: int
    pairs_per_task: int
    hot_groups: int
    global_buckets: int
    broadcast: bool
    split_broadcast: bool

    # Partitions of the split layout, one per (hot group, bucket): without groups
    # the buckets of the one group; with groups at most total/pairs_per_task +
    # groups < 2 * partitions.
    salt_slots: int

    # Columns and rows of the box of the points, without groups.
    width: int = 0
    height: int = 0


def _conf_int(spark: SparkSession, key: str, default: int) -> int:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # pragma: no cover - conf access never fails locally
        value = None
    return int(value) if value not in (None, "") else default


def parallelism(spark: SparkSession) -> int:
    try:
        return max(1, int(spark.sparkContext.defaultParallelism))
    except Exception:  # pragma: no cover - e.g. a Connect session
        return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))


def half_pair_count(n: str = "_n"):
    """n(n-1)/2 as BIGINT."""
    return F.call_function("div", F.col(n) * (F.col(n) - F.lit(1)), F.lit(2).cast("bigint"))


def group_sizes(pts: DataFrame, key_cols: list[str], more: Sequence[Column] = ()) -> DataFrame:
    """One row per group: its key columns, ``_n`` distinct points and ``_m`` max |coordinate|, and ``more``."""
    return pts.groupBy(*key_cols).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.greatest(F.abs(F.col("x")), F.abs(F.col("y")))).alias("_m"),
        *more,
    )


def measure(
    pts: DataFrame,
    key_cols: list[str],
    *,
    pairs_per_task: int | None = None,
    min_pairs_per_task: int | None = None,
    broadcast_max_bytes: int | None = None,
    allow_broadcast: bool = True,
) -> tuple[PairWorkload, DataFrame]:
    """Run the sizing aggregate; return the plan and the (lazy) group sizes."""
    spark = pts.sparkSession
    ppt = pairs_per_task or _conf_int(spark, CONF_PAIRS_PER_TASK, PAIRS_PER_TASK)
    mppt = min_pairs_per_task or _conf_int(spark, CONF_MIN_PAIRS_PER_TASK, MIN_PAIRS_PER_TASK)
    bmax = broadcast_max_bytes
    if bmax is None:
        bmax = _conf_int(spark, CONF_BROADCAST_MAX_BYTES, BROADCAST_MAX_BYTES)
    widths = [
        F.coalesce(F.octet_length(F.col(k)), F.lit(0)) if isinstance(pts.schema[k].dataType, (StringType, BinaryType)) else F.lit(8)
        for k in key_cols
    ]
    width = reduce(lambda a, b: a + b, widths, F.lit(POINT_BYTES))

    # the box of the one set; groups do not need theirs
    sides = [] if key_cols else [f(c).alias(f"_{n}_{c}") for c in ("x", "y") for n, f in (("min", F.min), ("max", F.max))]
    sizes = group_sizes(pts, key_cols, sides)
    any_null = F.lit(False)
    for k in key_cols:
        any_null = any_null | F.col(k).isNull()
    row = sizes.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_points"),
        F.coalesce(F.sum(half_pair_count()), F.lit(0)).alias("pairs"),
        F.coalesce(F.max("_n"), F.lit(0)).alias("max_n"),
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.max("_m"), F.lit(0)).alias("max_abs"),
        F.count(F.when(any_null, F.lit(1))).alias("null_keys"),
        F.coalesce(F.sum(F.col("_n") * width), F.lit(0)).alias("bytes"),
        *[F.max(f"_{n}_{c}") for c in ("x", "y") for n in ("min", "max") if sides],
    ).first()
    n_points, total, max_n, groups = int(row[0]), int(row[1]), int(row[2]), int(row[3])
    max_abs, null_keys, size = int(row[4]), int(row[5]), int(row[6])
    box = [int(row[k + 1]) - int(row[k]) + 1 for k in (7, 9)] if sides and n_points else [0, 0]

    par = parallelism(spark)
    by_work = min(math.ceil(total / ppt), MAX_PARTITIONS) if total else 1
    by_cores = min(2 * par, max(1, math.ceil(total / mppt))) if total else 1
    partitions = max(1, by_work, by_cores)
    per_task = max(1, math.ceil(total / partitions)) if total else ppt

    max_pairs_group = max_n * (max_n - 1) // 2
    # Exact count only without groups; with groups it is 0 (none) or -1 (some,
    # fewer than `partitions`: each carries more than total/partitions pairs).
    if key_cols:
        hot_groups = -1 if max_pairs_group > per_task else 0
        global_buckets = 1
    else:
        hot_groups = 1 if max_pairs_group > per_task else 0
        global_buckets = (
            max(
                1,
                min(
                    math.ceil(max_pairs_group / per_task), max_n // BUCKET_REPLICATION_DIVISOR, partitions,
                    SPLIT_BUCKETS_PER_CORE * par,
                ),
            )
            if hot_groups
            else 1
        )
    broadcast = bool(allow_broadcast and key_cols and size <= bmax)
    hot_size = size
    if key_cols and hot_groups and size > bmax:
        pairs = half_pair_count()
        hot_size = int(sizes.where(pairs > per_task).agg(F.coalesce(F.sum(F.col("_n") * width), F.lit(0))).first()[0])
    split_broadcast = bool(allow_broadcast and hot_groups and hot_size <= bmax)
    plan = PairWorkload(
        n_points=n_points,
        n_groups=groups,
        total_pairs=total,
        max_group=max_n,
        max_abs=max_abs,
        null_key_groups=null_keys,
        partitions=partitions,
        pairs_per_task=per_task,
        hot_groups=hot_groups,
        global_buckets=max(1, global_buckets),
        broadcast=broadcast,
        split_broadcast=split_broadcast,
        salt_slots=max(1, global_buckets) if not key_cols else 2 * partitions,
        width=box[0],
        height=box[1],
    )
    return plan, sizes


def hot_group_buckets(sizes: DataFrame, key_cols: list[str], plan: PairWorkload) -> DataFrame:
    """Groups with more than ``plan.pairs_per_task`` pairs and their bucket counts ``_s``.

    Row count < ``plan.partitions``: every row carries more than
    total_pairs / partitions pairs.
    """
    per_task = F.lit(plan.pairs_per_task).cast("bigint")
    pairs = half_pair_count()
    buckets = F.greatest(
        F.lit(1).cast("bigint"),
        F.least(
            F.call_function("div", F.col("_n"), F.lit(BUCKET_REPLICATION_DIVISOR).cast("bigint")),
            F.ceil(pairs.cast("double") / per_task.cast("double")).cast("bigint"),
            F.lit(min(plan.partitions, SPLIT_BUCKETS_PER_CORE * parallelism(sizes.sparkSession))).cast("bigint"),
        ),
    ).cast("int")
    return sizes.where(pairs > per_task).select(*key_cols, buckets.alias("_s"))
