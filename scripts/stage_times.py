"""Per-stage times from a Spark event log (no UI needed).

    COLLINE_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py lines_per_part
    python scripts/stage_times.py /tmp/run-XXXXXX/<event log file or folder>

Prints, per completed stage: id, tasks, wall seconds, summed task run time,
shuffle read / write bytes and spill bytes, then the stage name.
"""

from __future__ import annotations

import io
import json
import os
import sys


def _lines(path: str):
    """Event log lines from a file or a rolling event log folder (zstd or plain)."""
    files = [path]
    if os.path.isdir(path):
        files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("events_"))
    for f in files:
        if f.endswith(".zstd"):
            import zstandard

            with open(f, "rb") as fh:
                reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            yield from open(f, encoding="utf-8")


def main(path: str) -> None:
    stages = {}
    for line in _lines(path):
        if not line.strip():
            continue
        ev = json.loads(line)
        if ev.get("Event") != "SparkListenerStageCompleted":
            continue
        info = ev["Stage Info"]
        acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
        wall = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000.0
        stages[info["Stage ID"]] = (
            info["Number of Tasks"],
            wall,
            (acc.get("internal.metrics.executorRunTime") or 0) / 1000.0,
            acc.get("internal.metrics.shuffle.read.localBytesRead") or 0,
            acc.get("internal.metrics.shuffle.write.bytesWritten") or 0,
            (acc.get("internal.metrics.memoryBytesSpilled") or 0) + (acc.get("internal.metrics.diskBytesSpilled") or 0),
            info.get("Stage Name", "")[:60],
        )
    print(f"{'stage':>5} {'tasks':>5} {'wall_s':>7} {'task_s':>7} {'shuf_rd':>10} {'shuf_wr':>10} {'spill':>10}  name")
    for sid in sorted(stages):
        n, wall, run, rd, wr, sp, name = stages[sid]
        print(f"{sid:>5} {n:>5} {wall:>7.2f} {run:>7.2f} {rd:>10} {wr:>10} {sp:>10}  {name}")


if __name__ == "__main__":
    main(sys.argv[1])
