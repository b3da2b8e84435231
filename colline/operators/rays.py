"""The pair stage on arrays: all lines through some of the points of a group, without a shuffle of pairs.

Spark collects a group's points into one row and joins them with the group's
anchors (:func:`rows_by_group`, or :func:`rows_by_share` with several rows of
anchors for a large group); a task forms the pairs of a row's anchors with numpy.  An anchor meets all other
points of its group, so the points in one direction from it, before and after
it, are its whole line; the line is given out by its lowest anchor.  Nothing but
points goes in and nothing but whole lines comes out.

The slope dy/dx as DOUBLE is an exact key below ``EXACT_DOUBLE_BOUND``.  Beyond,
slopes that differ by rounding at most are compared by their exact reduced
directions (BIGINT, or two words of a DECIMAL); equal directions are never
further apart than that, so none is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, LongType, StructField, StructType

# Pairs formed at once, and lines and points given to Spark at once.
CHUNK_PAIRS = 1 << 18
OUT_LINES, OUT_POINTS = 1 << 14, 1 << 18
# Differences and their quotient are rounded by less than 2^-50 of the slope in all.
ROUNDING = 2.0**-48
# Coprime numbers whose product (2^185) is beyond twice dx1*dy2 - dx2*dy1 of neighbouring slopes (2^163).
MODULI = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549)
HIGH = 10**32


class _Points:
    """Coordinates of the groups of one chunk, one row a group, and differences between them."""

    def __init__(self, x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...], small: bool):
        self.x, self.y, self.small, self.wide = x, y, small, len(x) == 2

    def padded(self, at: np.ndarray) -> _Points:
        return _Points(tuple(v[at] for v in self.x), tuple(v[at] for v in self.y), self.small)

    def _minus(self, v: tuple[np.ndarray, ...], g: np.ndarray, b: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, ...]:
        """v[g, b] - v[g, a]: a number, or (sign, high word, low word) of one."""
        if not self.wide:
            return (v[0][g, b] - v[0][g, a],)
        low_b, low_a = v[1][g, b], v[1][g, a]
        low = low_b - low_a
        high = v[0][g, b] - v[0][g, a] - (low_b < low_a)
        back = high < 0
        return np.where(back, -1, 1), np.where(back, ~high + (low == 0), high), np.where(back, ~low + np.uint64(1), low)

    def slopes(self, g: np.ndarray, a: np.ndarray, members: np.ndarray) -> np.ndarray:
        rows = (g[:, None], members[None, :], a[:, None])
        dx, dy = self._minus(self.x, *rows), self._minus(self.y, *rows)
        if self.wide:
            dx, dy = (s * (h.astype(np.float64) * 2.0**64 + w.astype(np.float64)) for s, h, w in (dx, dy))
        else:
            dx, dy = dx[0], dy[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            out = dy / dx
        out[dx == 0] = np.inf
        return out

    def directions(self, g: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact reduced directions from points a to b (a before b or not), with ux > 0 or (0, 1)."""
        dx, dy = self._minus(self.x, g, b, a), self._minus(self.y, g, b, a)
        if not self.wide:
            dx, dy = dx[0], dy[0]
            d = np.gcd(dx, dy) * np.where((dx < 0) | ((dx == 0) & (dy < 0)), -1, 1)
            return dx // d, dy // d
        dx, dy = ([s * ((h << 64) | w) for s, h, w in zip(*(c.tolist() for c in v))] for v in (dx, dy))
        out = []
        for p, q in zip(dx, dy):
            d = math.gcd(p, q)
            d = -d if p < 0 or (p == 0 and q < 0) else d
            out.append((p // d, q // d))
        u, v = np.empty(len(out), object), np.empty(len(out), object)
        u[:], v[:] = [p for p, _ in out], [q for _, q in out]
        return u, v

    def parallel(self, g: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether two words' directions a to b of an entry and of the next one are the same; their slopes differ by rounding.

        dx1*dy2 - dx2*dy1 is 0 exactly if it is 0 by every one of :data:`MODULI`.
        """
        sides = self._minus(self.x, g, b, a), self._minus(self.y, g, b, a)
        out = np.ones(max(0, len(g) - 1), bool)
        for q in MODULI:
            by, shift = np.uint64(q), np.uint64(2**64 % q)
            x, y = (((h.view(np.uint64) % by * shift + w % by) % by, s) for s, h, w in sides)
            x, y = (np.where(s < 0, (by - r) % by, r) for r, s in (x, y))
            out &= x[:-1] * y[1:] % by == x[1:] * y[:-1] % by
        return out

    def value(self, v: tuple[np.ndarray, ...], g: np.ndarray, b: np.ndarray) -> list[int]:
        return [(h << 64) + w for h, w in zip(v[0][g, b].tolist(), v[1][g, b].tolist())]


def _runs(pts: _Points, g: np.ndarray, a: np.ndarray, m: int, inside: np.ndarray | None, left_out: np.ndarray, need: int):
    """Runs of ``need`` or more points in one direction from an anchor.

    Row k is anchor ``a[k]`` of group ``g[k]``; ``inside`` (rows by points) says
    which points it meets, ``left_out`` the ones past the end of a smaller group.
    Returns (rows of all entries, their points, starts of the runs, lengths);
    the points of a run ascend.
    """
    slope = pts.slopes(g, a, np.arange(m))
    slope[left_out if inside is None else left_out | ~inside] = np.nan
    slope[np.arange(len(a)), a] = np.nan
    order = np.argsort(slope, axis=1)
    slope = np.take_along_axis(slope, order, 1)
    same = slope[:, 1:] == slope[:, :-1]
    if not pts.small:
        with np.errstate(invalid="ignore"):
            same |= np.abs(slope[:, 1:] - slope[:, :-1]) <= ROUNDING * np.abs(slope[:, 1:])
    entry = np.zeros(slope.shape, bool)
    entry[:, 1:] = same
    entry[:, :-1] |= same
    row, place = np.nonzero(entry)
    p = order[row, place]
    fresh = np.ones(len(row), bool)
    later = place > 0
    fresh[later] = ~same[row[later], place[later] - 1]
    run = np.cumsum(fresh) - 1
    if pts.wide and len(run):
        # neighbours that are not parallel: slopes too close for DOUBLE, told apart entry by entry
        apart = ~fresh[1:] & ~pts.parallel(g[row], a[row], p)
        close = np.zeros(run[-1] + 1, bool)
        close[run[1:][apart]] = True
        told = np.flatnonzero(close[run])
        if len(told):
            codes: dict[tuple, int] = {}
            ways = zip(run[told].tolist(), *pts.directions(g[row[told]], a[row[told]], p[told]))
            run[told] = len(close) + np.array([codes.setdefault(k, len(codes)) for k in ways], np.int64)
    elif not pts.small:
        u, v = pts.directions(g[row], a[row], p)
        by = np.lexsort((v, u, run))
        fresh = np.ones(len(by), bool)
        fresh[1:] = (np.diff(run[by]) != 0) | (np.diff(u[by]) != 0) | (np.diff(v[by]) != 0)
        split = np.empty(len(by), np.int64)
        split[by] = np.cumsum(fresh) - 1
        run = split
    by = np.argsort(run * m + p)
    row, p, run = row[by], p[by], run[by]
    starts = np.flatnonzero(np.r_[True, np.diff(run) != 0]) if len(run) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, len(run)])
    enough = sizes >= need
    if not enough.all():
        held = np.repeat(enough, sizes)
        row, p, sizes = row[held], p[held], sizes[enough]
        starts = np.cumsum(sizes) - sizes
    return row, p, starts, sizes


def _led(row, p, starts, sizes, keep: np.ndarray):
    """Only the runs with ``keep``."""
    held = np.repeat(keep, sizes)
    sizes = sizes[keep]
    return row[held], p[held], np.cumsum(sizes) - sizes, sizes


def _chunk(pts: _Points, count: np.ndarray, g: np.ndarray, a: np.ndarray, m: int, lead: np.ndarray | None, dealt: np.ndarray | None, min_points: int, share: int):
    """The lines that the anchors ``a`` of groups ``g`` give out: (row, points, starts, sizes) without the anchor.

    A line is given out by its lowest point, with ``lead`` by its lowest point
    that leads.  With ``dealt`` (a bucket of every point) only lines with
    ``share`` points in one bucket count: the search is made inside the buckets,
    its anchors then meet all points, and the line is given out by the lowest
    point of its first bucket with as many.
    """
    beyond = np.arange(m)[None, :] >= count[g][:, None]
    if dealt is not None:
        row, _, starts, _ = _runs(pts, g, a, m, dealt[g] == dealt[g, a][:, None], beyond, share - 1)
        found = np.unique(row[starts])
        g, a, beyond = g[found], a[found], beyond[found]
    row, p, starts, sizes = _runs(pts, g, a, m, None, beyond, min_points - 1)
    if not len(starts):
        return g, a, row, p, starts, sizes
    of = row[starts]
    if dealt is not None:
        own, mark = dealt[g[of], a[of]], dealt[g[row], p]
        keep = np.ones(len(starts), bool)
        for k in range(int(dealt.max()) + 1):
            n = np.add.reduceat((mark == k).astype(np.int64), starts) + (own == k)
            keep &= np.where(own == k, n >= share, (own < k) | (n < share))
        before = np.where(mark == np.repeat(own, sizes), p, m)
        keep &= np.minimum.reduceat(before, starts) > a[of]
    elif lead is not None:
        keep = np.minimum.reduceat(np.where(lead[g[row], p], p, m), starts) > a[of]
    else:
        keep = p[starts] > a[of]
    return g, a, *_led(row, p, starts, sizes, keep)


def _words(values: pa.Array) -> tuple[np.ndarray, ...]:
    """Numbers of an Arrow column: BIGINT, or the high and low words of a DECIMAL."""
    if not pa.types.is_decimal(values.type):
        return (values.to_numpy(zero_copy_only=False),)
    raw = np.frombuffer(values.buffers()[1], np.int64)[2 * values.offset : 2 * (values.offset + len(values))]
    return raw[1::2], raw[0::2].view(np.uint64)


def _blocks(sizes: np.ndarray, slot: np.ndarray, slots: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(groups, first anchor, anchors): many small groups at a time, or some anchors of one."""
    alone = (slots > 1) | (sizes * sizes > CHUNK_PAIRS)
    for k in np.flatnonzero(alone & (sizes > 2)):
        own = np.arange(slot[k], sizes[k], slots[k])
        step = max(1, CHUNK_PAIRS // int(sizes[k]))
        for i in range(0, len(own), step):
            yield np.array([k]), own[i : i + step]
    few = np.flatnonzero(~alone & (sizes > 2))
    few = few[np.argsort(-sizes[few], kind="stable")]
    while len(few):
        n = max(1, CHUNK_PAIRS // int(sizes[few[0]]) ** 2)
        yield few[:n], np.arange(sizes[few[0]])
        few = few[n:]


def _lines_of_rows(rows: pa.RecordBatch, keys: list[str], small: bool, min_points: int, share: int) -> Iterator[pa.RecordBatch]:
    lists = rows.column("_pts")
    values = lists.flatten()
    names = [f.name for f in values.type]
    fields = dict(zip(names, values.flatten()))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum(sizes) - sizes
    every = _Points(_words(fields["x"]), _words(fields["y"]), small)
    flag = fields["_lead"].to_numpy(zero_copy_only=False) if "_lead" in fields else None
    bucket = fields["_in"].to_numpy(zero_copy_only=False) if "_in" in fields else None
    slot, slots = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("_slot", "_slots"))

    held: list[tuple] = []
    n_lines = n_points = 0

    def given() -> pa.RecordBatch:
        line_row, points, counts, *rest = (np.concatenate(c) for c in zip(*held))
        ends = np.r_[0, np.cumsum(counts)].astype(np.int32)
        at = pa.array(points)
        found = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([fields[c].take(at) for c in ("x", "y")], names=["x", "y"]))
        out = [rows.column(k).take(pa.array(line_row)) for k in keys]
        if every.wide:
            out += [pa.array([Decimal(n) for n in c.tolist()], pa.decimal128(38, 0)) for c in rest]
        else:
            out += [pa.array(c) for c in rest]
        return pa.RecordBatch.from_arrays([*out, found], names=[*keys, "ux", "uy", *(["c_hi", "c_lo"] if every.wide else []), "points"])

    for groups, anchors in _blocks(sizes, slot, slots):
        count = sizes[groups]
        m = int(count.max())
        at = first[groups][:, None] + np.minimum(np.arange(m)[None, :], count[:, None] - 1)
        pts = every.padded(at)
        may = np.broadcast_to(anchors[None, :] < count[:, None], (len(groups), len(anchors)))
        lead = None if flag is None else flag[at]
        if lead is not None:
            may = may & lead[:, anchors]
        g, a = np.nonzero(may)
        a = anchors[a]
        g, a, row, p, starts, counts = _chunk(pts, count, g, a, m, lead, None if bucket is None else bucket[at], min_points, share)
        if not len(starts):
            continue
        of = row[starts]
        lg, la = g[of], a[of]
        u, v = pts.directions(lg, la, p[starts])
        # the anchor takes its place among the points of its line
        ends = starts + counts
        line = np.repeat(np.arange(len(starts)), counts)
        everyone = np.r_[line * m + p, np.arange(len(starts)) * m + la]
        everyone.sort()
        rest: list[np.ndarray] = [u, v]
        if every.wide:
            c = [q * y - w * x for q, w, x, y in zip(u, v, pts.value(pts.x, lg, la), pts.value(pts.y, lg, la))]
            halves = [divmod(n, HIGH) for n in c]
            for k in (0, 1):
                col = np.empty(len(c), object)
                col[:] = [h[k] for h in halves]
                rest.append(col)
        points = at[np.repeat(lg, counts + 1), everyone % m]
        held.append((groups[lg], points, counts + 1, *rest))
        n_lines += len(ends)
        n_points += len(points)
        if n_lines >= OUT_LINES or n_points >= OUT_POINTS:
            yield given()
            held, n_lines, n_points = [], 0, 0
    if held:
        yield given()


def array_lines(rows: DataFrame, keys: list[str], small: bool, min_points: int = 3, share: int = 0) -> DataFrame:
    """Lines of rows of :func:`rows_by_group` or :func:`rows_by_share`: ``keys, ux, uy, points``, for DECIMAL points ``c_hi, c_lo`` too."""
    point = rows.schema["_pts"].dataType.elementType
    wide = isinstance(point["x"].dataType, DecimalType)
    number = DecimalType(38, 0) if wide else LongType()
    xy = StructType([StructField(c, number) for c in ("x", "y")])
    schema = StructType(
        [*[rows.schema[k] for k in keys], *[StructField(c, number) for c in ("ux", "uy", *(("c_hi", "c_lo") if wide else ()))], StructField("points", ArrayType(xy))]
    )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _lines_of_rows(batch, keys, small, min_points, share)

    return rows.mapInArrow(search, schema)


def _points_of(pts: DataFrame, keys: list[str], marks: list[str] | None) -> DataFrame:
    """One row a group with its sorted points, with the columns ``marks`` in them."""
    return pts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("x", "y", *(marks or [])))).alias("_pts"))


def rows_by_group(pts: DataFrame, keys: list[str], partitions: int, broadcast: bool, marks: list[str] | None = None) -> DataFrame:
    """``keys, _pts, _slot, _slots``: one row a group, dealt out by group, whose anchors are all its points.

    The groups' keys (each a row of anchors) are joined with the groups' points:
    broadcast where the points would fit, else both sides by the same partitioning.
    """
    groups = pts.select(*[F.col(k).alias(k + "_b") for k in keys]).distinct()
    if broadcast:
        # fewer bytes than the measured ones of the points, which are within the bound
        groups = F.broadcast(groups)
    else:
        groups = groups.repartition(partitions, *[k + "_b" for k in keys]).hint("merge")
    points = _points_of(pts.repartition(partitions, *keys), keys, marks)
    rows = points.join(groups, [F.col(k) == F.col(k + "_b") for k in keys])
    return rows.select(*keys, "_pts", F.lit(0).alias("_slot"), F.lit(1).alias("_slots"))


def rows_by_share(pts: DataFrame, keys: list[str], slots: int, marks: list[str] | None = None) -> DataFrame:
    """:func:`rows_by_group` for groups that one task cannot take: ``_s`` rows a group, each with its share of the anchors.

    The points of these groups are within the broadcast bound; the rows of
    shares are dealt out and meet them.  Without keys ``slots`` is that of all points.
    """
    points = _points_of(pts, keys, marks)
    if keys:
        shares = pts.groupBy(*[F.col(k).alias(k + "_b") for k in keys]).agg(F.max("_s").alias("_slots"))
        shares = shares.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.col("_slots") - F.lit(1))))
        shares = shares.repartition(slots, *[k + "_b" for k in keys], "_slot")
        on = [F.col(k) == F.col(k + "_b") for k in keys]
    else:
        # one share a partition; 0 in every row of both sides is their key
        shares = pts.sparkSession.range(0, slots, 1, slots).select(F.col("id").cast("int").alias("_slot"), F.lit(slots).alias("_slots"))
        shares = shares.withColumn("_zero_b", F.shiftright("_slot", 31))
        points = points.withColumn("_zero", F.shiftright(F.size("_pts"), 31))
        on = [F.col("_zero") == F.col("_zero_b")]
    return shares.join(F.broadcast(points), on).select(*keys, "_pts", "_slot", "_slots")
