"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is timed end to end: plan construction (including the engine's
eager sizing job) plus a full run into Spark's ``noop`` sink, which computes
every output column without collecting to the driver.  Before timing, every
headline query runs once on the smallest tables next to ``BENCH_SF_DIR``
(``sf0.001``) so JVM warm-up does not land on the timed runs; that time is
reported separately as ``warmup_sec``.  Each query then runs
``BENCH_REPEAT`` times (default 3) from the parquet files (nothing is cached
between runs) and the median is reported, because a shared host makes single
runs noisy; all runs are listed under ``runs``.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from colline.plans import tables as T  # noqa: E402
from colline.session import local_session  # noqa: E402

HEADLINE = [
    "lines_supplier",
    "lines_lineitem_grid",
    "lines_customer",
    "lines_per_part",
    "lines_per_supplier",
    "lines_rich_customer",
    "points_on_lines_per_part",
    "anchor_groups",
    "same_sets",
    "ordered_pairs_per_order",
    "parse_points",
]


def _run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = T.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="colline-bench")
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    t0 = time.perf_counter()
    if os.path.isdir(warm_dir):
        for name in names:
            _run(spark, name, warm_dir)
    warm = time.perf_counter() - t0
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    runs = {name: [round(_run(spark, name, sf_dir), 3) for _ in range(repeat)] for name in names}
    times = {name: sorted(r)[len(r) // 2] for name, r in runs.items()}
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "warmup_sec": round(warm, 3),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
