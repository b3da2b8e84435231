"""Exact top-k search (operator 7): block-at-a-time pruning over forward indexes.

Vectors are queries and documents; a component is a term and its integer value
the weight.  The index cuts the documents, in the order of their ids, into
ranges of 2048 rows; a range is one row of the index with its forward index
(ids and weights) and, for each of its blocks of 128 documents, the largest and
smallest weight of every term.  The sum of the best products of a query with
these bounds every score in the block.

A query first searches its own range; its k-th score there is a floor.  Then
queries are dealt into sets of at most :data:`QUERY_BYTES` and ranges into
:data:`GROUPS` groups.  A task holds one set of queries, reads the ranges of one
group one after the other and keeps the k best of each query so far: blocks are
taken in the order of their bounds and scored through the forward index until
the bound of the next block falls below the k-th score so far (or the floor).  A
score equal to the k-th still counts, as ties go to the smaller id.  A row is
named by its range and place, so rows with one id are rows of their own.  At
most k results a query leave a group, so what is sorted in the end grows with
the queries, not with queries times ranges; a window picks the k best of these.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colline.llm.common import save

RANGE, BLOCK, SCALE = 2048, 128, 64.0
GROUPS = 4  # of ranges; each sends at most k results a query
QUERY_BYTES = 16 << 20  # weights of the queries that one task holds, on average
PARTITIONS = 20_000  # at most; beyond it a partition has several sets, one after the other

SMALL = 2**31  # weights below it are kept as 32-bit integers, a range with larger ones as doubles (whole numbers)


def _weights(vectors: list[list[float] | None]) -> tuple[list[int], np.ndarray]:
    """Positions of the usable vectors, and floor(64 * x) of their components (shorter ones padded with 0)."""
    good = [i for i, v in enumerate(vectors) if v is not None and all(x is not None for x in v) and np.isfinite(v).all()]
    width = max((len(vectors[i]) for i in good), default=0)
    out = np.zeros((len(good), width), dtype=np.float64)
    for row, i in enumerate(good):
        out[row, : len(vectors[i])] = vectors[i]
    # beyond 2**53 every double is whole, so the scaling is exact there; it is done on less than the largest double
    out = np.where(np.abs(out) < 2.0**1000, np.floor(np.clip(out, -(2.0**1000), 2.0**1000) * SCALE), np.nan)
    if np.isnan(out).any():
        raise ValueError("a component of 2**1000 or more has no score")
    return good, out.astype(np.int32) if np.abs(out).max(initial=0.0) < SMALL else out


def _array(data: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(data, dtype=np.float64 if wide else np.int32)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of consecutive rows of a sorted partition, one output row each."""
    part, count = TaskContext.get().partitionId(), 0
    ids: list[int] = []
    vectors: list = []

    def emit(n: int) -> pa.RecordBatch | None:
        nonlocal count
        good, w = _weights(vectors[:n])
        kept = np.array([ids[i] for i in good], dtype=np.int64)
        del ids[:n], vectors[:n]
        if not len(kept):
            return None
        starts = range(0, len(kept), BLOCK)
        high = np.array([w[s : s + BLOCK].max(axis=0) for s in starts], dtype=w.dtype)
        low = np.array([w[s : s + BLOCK].min(axis=0) for s in starts], dtype=w.dtype)
        count += 1
        row = [part * 2**24 + count, w.dtype == np.float64, w.shape[1], kept.tobytes(), w.tobytes(), high.tobytes(), low.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["range", "wide", "width", "ids", "weights", "high", "low"])

    for batch in batches:
        ids += batch.column(0).to_pylist()
        vectors += batch.column(1).to_pylist()
        while len(ids) >= RANGE:
            if (out := emit(RANGE)) is not None:
                yield out
    if ids and (out := emit(len(ids))) is not None:
        yield out


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``range, wide, width, ids, weights, high, low``: the block index of all usable vectors.

    Rows with a null id take no part, nor do vectors that are null or hold a
    null or non-finite component.  Every other row is indexed, rows with one id
    as well: a row's name is its range and its place there.
    """
    rows = vectors.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    parts = max(1, -(-rows.count() // (4 * RANGE)))
    rows = rows.repartitionByRange(parts, "id").sortWithinPartitions("id", "v")
    return save(rows.mapInArrow(_pack, "range long, wide boolean, width long, ids binary, weights binary, high binary, low binary"), "topk-index")


class Best:
    """The best k of one query so far, ties to the smaller id, and the least score that can still count."""

    def __init__(self, floor: int | None = None):
        self.scores, self.ids, self.floor = np.empty(0, np.int64), np.empty(0, np.int64), floor

    def add(self, scores: np.ndarray, ids: np.ndarray, k: int) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        if len(scores) >= k:
            if scores.dtype == object:
                first = sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j]))[:k]
            else:
                first = np.lexsort((ids, -scores))[:k]
            scores, ids = scores[first], ids[first]
            self.floor = int(scores[-1]) if self.floor is None else max(self.floor, int(scores[-1]))
        self.scores, self.ids = scores, ids


class _Range:
    """One row of the index, unpacked.  ``names`` are those of its rows: range * 2048 + place."""

    def __init__(self, r: dict):
        self.ids = np.frombuffer(r["ids"], dtype=np.int64)
        self.names = r["range"] * RANGE + np.arange(len(self.ids))
        self.weights = _array(r["weights"], r["wide"]).reshape(len(self.ids), r["width"])
        self.high = _array(r["high"], r["wide"]).reshape(-1, r["width"])
        self.low = _array(r["low"], r["wide"]).reshape(-1, r["width"])

    def search(self, query_names: np.ndarray, queries: np.ndarray, best: list[Best], k: int) -> None:
        """Bring each query's best k up to date with the rows of this range.

        Scores are exact: doubles where products and sums stay below 2**53,
        else 64-bit integers, else Python's.
        """
        width = min(self.weights.shape[1], queries.shape[1])
        most = int(np.abs(self.weights).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(width, 1)
        kind = np.float64 if most < 2**53 else np.int64 if most < 2**63 else object

        def exact(x: np.ndarray) -> np.ndarray:
            x = x[:, :width]
            return np.array([[int(c) for c in row] for row in x], dtype=object).reshape(x.shape) if kind is object else x.astype(kind)

        w, q, up, down = map(exact, (self.weights, queries, self.high, self.low))
        bounds = np.maximum(q, 0) @ up.T + np.minimum(q, 0) @ down.T
        orders = np.argsort(-bounds, axis=1, kind="stable")
        for i, mine in enumerate(best):
            for b in orders[i]:
                if mine.floor is not None and bounds[i, b] < mine.floor:
                    break
                rows = slice(b * BLOCK, (b + 1) * BLOCK)
                s = w[rows] @ q[i]
                good = self.names[rows] != query_names[i]
                if mine.floor is not None:
                    good &= (s >= mine.floor).astype(bool)
                if good.any():
                    mine.add(s[good] if kind is object else s[good].astype(np.int64), self.ids[rows][good], k)


_BATCH_SQL = "batch long, qwide boolean, qwidth long, qnames binary, qids binary, queries binary, floors array<string>"


def _batches(k: int, every: int):
    """Queries of each range, with their floors from their own range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at = _Range(r)
                mine = np.flatnonzero(at.ids % every == 0)
                if not len(mine):
                    continue
                names, q = at.names[mine], at.weights[mine]
                best = [Best() for _ in names]
                at.search(names, q, best, k)
                floors = [None if x.floor is None else str(x.floor) for x in best]
                row = [r["range"], r["wide"], r["width"], names.tobytes(), at.ids[mine].tobytes(), q.tobytes()]
                columns = [pa.array([x]) for x in row] + [pa.array([floors], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=["batch", "qwide", "qwidth", "qnames", "qids", "queries", "floors"])

    return run


_FOUND_SQL = "query_name long, query_id long, vec_id long, score decimal(38,0)"


class _Queries:
    """A set of queries of one task: packed rows of several ranges."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, list[Best]]] = []

    def add(self, r: dict) -> None:
        names, ids = (np.frombuffer(r[c], dtype=np.int64) for c in ("qnames", "qids"))
        weights = _array(r["queries"], r["qwide"]).reshape(len(ids), r["qwidth"])
        self.parts.append((names, ids, weights, [Best(None if f is None else int(f)) for f in r["floors"]]))

    def search(self, at: _Range, k: int) -> None:
        for names, _, weights, best in self.parts:
            at.search(names, weights, best, k)

    def found(self) -> Iterator[pa.RecordBatch]:
        for names, ids, _, best in self.parts:
            sizes = [len(x.ids) for x in best]
            if sum(sizes):
                scores = [int(s) for x in best for s in x.scores]
                if max(map(abs, scores)) >= 10**38:
                    raise ValueError("a score of more than 38 digits")
                columns = [pa.array(x) for x in (np.repeat(names, sizes), np.repeat(ids, sizes), np.concatenate([x.ids for x in best]))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([Decimal(x) for x in scores], pa.decimal128(38, 0))], names=["query_name", "query_id", "vec_id", "score"]
                )


def _search(k: int):
    """Results of every (set of queries, group of ranges) of a sorted partition, whose queries come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, _Queries()
        for batch in batches:
            for n in range(batch.num_rows):
                r = batch.slice(n, 1).to_pylist()[0]
                if (r["set"], r["group"]) != now:
                    yield from held.found()
                    now, held = (r["set"], r["group"]), _Queries()
                if r["range"] is None:
                    held.add(r)
                elif held.parts:
                    held.search(_Range(r), k)
        yield from held.found()

    return run


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every vector whose id is divisible by ``every``,
    the ``k`` other vectors with the highest inner product of floor(64 x), ties to the smaller id.

    All candidates if there are fewer than ``k``.  Every usable row is a
    candidate for every query but itself: rows with the query's id and other
    rows with one id count too, and each row with a query's id is a query of its
    own.  Vectors of different length count as 0 where one has no component.
    Ranks go by exact scores; a score that does not fit a BIGINT is null, one
    of more than 38 digits raises, as does a component of 2**1000 or more.  An
    empty table, or one without a query, gives an empty result.
    """
    index = build_index(vectors, id_col, vector_col)
    queries = save(index.mapInArrow(_batches(k, every), _BATCH_SQL), "topk-queries")
    total, rows = queries.agg(F.coalesce(F.sum(F.octet_length("queries")), F.lit(0)), F.count(F.lit(1))).first()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    sets = max(1, -(-total // QUERY_BYTES), min(rows, -(-2 * cores // GROUPS)))  # few, but enough to use all cores

    def dealt(df: DataFrame, own: str, key: str, n: int, other: str, m: int) -> DataFrame:
        here = F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias(own)
        return df.select("*", here, F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))

    left = dealt(queries, "set", "batch", sets, "group", GROUPS).drop("batch")
    both = left.unionByName(dealt(index, "group", "range", GROUPS, "set", sets), allowMissingColumns=True)
    both = both.repartition(min(sets * GROUPS, PARTITIONS), "set", "group").sortWithinPartitions("set", "group", F.asc_nulls_first("range"))
    found = both.mapInArrow(_search(k), _FOUND_SQL)
    line = Window.partitionBy("query_name").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(line)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", F.col("score").try_cast("bigint").alias("score"))
