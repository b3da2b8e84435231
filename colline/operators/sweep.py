"""All lines of one dense set of points by direction: no pairs are formed.

A line of k points in a box of W by H lattice points has k - 1 gaps in W - 1
columns and H - 1 rows, so by the pigeonhole principle its primitive direction
has ux <= (W - 1) / (k - 1) and abs(uy) <= (H - 1) / (k - 1).  Every task gets the
points (a size-checked broadcast) as a grid of bytes and a share of these
directions.  The lattice lines of a direction are slanted columns of the grid:
their points are counted by adding rows of the grid to each other, and lines of
k or more are read off.  The work is directions times W times H, whatever the
number of points, and the rest is proportional to the result.

This pays where the points are dense in their box; otherwise, and for groups,
pairs are formed (:mod:`colline.operators.rays`).  Both are exact: here all is
integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import as_strided
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from colline.operators.rays import OUT_LINES, OUT_POINTS, rows_by_share
from colline.operators.workload import MAX_PARTITIONS, SPLIT_BUCKETS_PER_CORE, PairWorkload, _conf_int, parallelism

# Fewer pairs than this take no time worth saving.
SWEEP_MIN_PAIRS = 1 << 24
CONF_SWEEP_MIN_PAIRS = "colline.sweepMinPairs"
# Cells of the grid that are added up in the time of a pair (measured: 0.5 ns against 150 ns).
CELLS_PER_PAIR = 256
# Bytes of a task's grid.
MAX_CELLS = 1 << 25
# A set of n points has at most n^2 / (k * (k - 1)) lines of k points; so many of these go to one task.
LINES_PER_TASK = 1 << 24
# Cells read off at once.
CHUNK_CELLS = 1 << 20


def sweep_work(plan: PairWorkload, min_points: int) -> int:
    """Cells that a sweep of all directions adds up, at most."""
    w, h = plan.width, plan.height
    return 2 * w * h * ((w - 1) // (min_points - 1) * (2 * ((h - 1) // (min_points - 1)) + 1) + 1)


def sweeps(spark, plan: PairWorkload, min_points: int, pairs: int) -> bool:
    """Whether the one set of points that ``plan`` measured is swept: less work than forming ``pairs``, and it fits."""
    return (
        pairs >= _conf_int(spark, CONF_SWEEP_MIN_PAIRS, SWEEP_MIN_PAIRS)
        and plan.width * plan.height <= MAX_CELLS
        and sweep_work(plan, min_points) <= CELLS_PER_PAIR * pairs
    )


class _Grid:
    """Points as bytes, the longer side of their box as rows in memory, and the same with y turned round."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.x0, self.y0 = int(x.min()), int(y.min())
        self.top = int(y.max()) - self.y0
        x, y = x - self.x0, y - self.y0
        self.turned = int(x.max()) > self.top
        a, b = (y, x) if self.turned else (x, y)
        self.w, self.h = int(a.max()) + 1, int(b.max()) + 1
        kind = next(t for t in (np.uint8, np.uint16, np.uint32) if self.w <= np.iinfo(t).max)
        # past its end every row has zeros: a slanted column may run out there
        self.row = 2 * self.h
        self.cells = []
        for back in (False, True):
            cells = np.zeros((self.w, self.row), kind)
            p, q = (self.w - 1 - a if back and self.turned else a), (self.h - 1 - b if back and not self.turned else b)
            cells[p, q] = 1
            self.cells.append(cells.ravel())

    def directions(self, k: int, slot: int, slots: int) -> tuple[np.ndarray, ...]:
        """(a, b, whether y falls): this slot's share of the directions of lines of k points, a along the shorter side."""
        p, q = np.meshgrid(np.arange(1, (self.w - 1) // (k - 1) + 1), np.arange((self.h - 1) // (k - 1) + 1), indexing="ij")
        coprime = np.gcd(p, q) == 1
        p, q = p[coprime], q[coprime]
        a, b, back = np.r_[p, p[q > 0]], np.r_[q, q[q > 0]], np.r_[np.zeros(len(p), bool), np.ones((q > 0).sum(), bool)]
        by = np.lexsort((back, b, a))[slot::slots]
        return a[by], b[by], back[by]

    def _blocks(self, a: int, b: int, k: int) -> Iterator[tuple[int, int, int, int]]:
        """(first column, columns, steps, places): lattice points without one before them in the direction, by steps left to them."""
        column = np.arange(self.w)
        steps = (self.w - 1 - column) // a + 1
        if b:
            steps = np.minimum(steps, (self.h - 1) // b + 1)
        places = np.where(column < a, self.h, b)
        cuts = np.flatnonzero((np.diff(steps) != 0) | (np.diff(places) != 0)) + 1
        for i, j in zip(np.r_[0, cuts], np.r_[cuts, self.w]):
            if steps[i] >= k and places[i]:
                yield int(i), int(j - i), int(steps[i]), int(places[i])

    def lines(self, a: int, b: int, back: bool, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(sizes, x, y) of the lines of k or more points in a direction, their points by x."""
        cells = self.cells[back]
        for i, n, steps, places in self._blocks(a, b, k):
            seen = as_strided(cells[i * self.row :], (n, steps, places), tuple(cells.itemsize * s for s in (self.row, a * self.row + b, 1)))
            count = np.add.reduce(seen, axis=1, dtype=cells.dtype)
            column, place = np.nonzero(count >= k)
            size = max(1, CHUNK_CELLS // steps)
            for at in range(0, len(column), size):
                c, p = column[at : at + size], place[at : at + size]
                line, step = np.nonzero(seen[c, :, p])
                yield (count[c, p].astype(np.int64), *self._xy(i + c[line] + step * a, p[line] + step * b, back))

    def straight(self, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """:meth:`lines` along the longer side."""
        for c in range(self.w):
            p = np.flatnonzero(self.cells[0][c * self.row : (c + 1) * self.row])
            if len(p) >= k:
                yield (np.array([len(p)]), *self._xy(np.full(len(p), c), p, False))

    def _xy(self, a: np.ndarray, b: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray]:
        x, y = (b, a) if self.turned else (a, b)
        return x, self.top - y if back else y


def _swept(grid: _Grid, k: int, slot: int, slots: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(ux, uy, sizes, x, y) of this slot's lines, counted from the corner of the box."""
    if slot == 0:
        for found in grid.straight(k):
            yield (1, 0, *found) if grid.turned else (0, 1, *found)
    for a, b, back in zip(*(v.tolist() for v in grid.directions(k, slot, slots))):
        ux, uy = (b, a) if grid.turned else (a, b)
        for found in grid.lines(a, b, back, k):
            yield ux, -uy if back else uy, *found


def _lines_of_row(points: pa.Array, slot: int, slots: int, k: int, text: bool) -> Iterator[pa.RecordBatch]:
    x, y = (c.to_numpy(zero_copy_only=False) for c in points.flatten())
    grid = _Grid(x, y)
    names = number = None
    if text:
        number = np.zeros((int(x.max()) - grid.x0 + 1, int(y.max()) - grid.y0 + 1), np.int32)
        number[x - grid.x0, y - grid.y0] = np.arange(len(x))
        names = pa.array([f"{p} {q}" for p, q in zip(x.tolist(), y.tolist())], pa.string())
    held: list[tuple] = []
    n_lines = n_points = 0

    def given() -> pa.RecordBatch:
        px, py = (np.concatenate([h[i] for h in held]) for i in (3, 4))
        sizes = np.concatenate([h[2] for h in held])
        ux, uy = (np.repeat([h[i] for h in held], [len(h[2]) for h in held]) for i in (0, 1))
        ends = np.r_[0, np.cumsum(sizes)]
        first = ends[:-1]
        c = ux * (py[first] + grid.y0) - uy * (px[first] + grid.x0)
        offsets = pa.array(ends.astype(np.int32))
        if text:
            found = pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(pa.array(number[px, py]))), ";")
        else:
            found = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(px + grid.x0), pa.array(py + grid.y0)], names=["x", "y"]))
        return pa.RecordBatch.from_arrays([*(pa.array(v) for v in (ux, uy, c, sizes)), found], names=["ux", "uy", "c", "n_points", "points"])

    for found in _swept(grid, k, slot, slots):
        if not len(found[2]):
            continue
        held.append(found)
        n_lines += len(found[2])
        n_points += len(found[3])
        if n_lines >= OUT_LINES or n_points >= OUT_POINTS:
            yield given()
            held, n_lines, n_points = [], 0, 0
    if held:
        yield given()


def sweep_lines(pts: DataFrame, plan: PairWorkload, min_points: int = 3, text: bool = False) -> DataFrame:
    """``ux, uy, c, n_points, points`` of the distinct points ``x, y``, which are one set that :func:`sweeps`.

    ``text`` gives the points as :func:`colline.functions.geometry.points_text` does.
    """
    lines = plan.n_points**2 // (min_points * (min_points - 1))
    slots = max(SPLIT_BUCKETS_PER_CORE * parallelism(pts.sparkSession), min(math.ceil(lines / LINES_PER_TASK), MAX_PARTITIONS))
    kind = StringType() if text else ArrayType(StructType([StructField(c, LongType()) for c in ("x", "y")]))
    schema = StructType([*[StructField(c, LongType()) for c in ("ux", "uy", "c", "n_points")], StructField("points", kind)])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, own, all_ = (batch.column(c) for c in ("_pts", "_slot", "_slots"))
            for i in range(len(batch)):
                yield from _lines_of_row(lists[i].values, own[i].as_py(), all_[i].as_py(), min_points, text)

    found = rows_by_share(pts.select("x", "y"), [], slots).mapInArrow(search, schema)
    return found.withColumn("c", F.col("c").cast("decimal(38,0)"))
