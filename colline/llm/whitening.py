"""Embedding whitening (operator 13): principal components with unit variance.

1. Every usable vector becomes integers; the fit list holds each distinct
   integer vector once.  Vectors travel as packed bytes, so equal ones collapse
   in the tasks that read them before anything is shuffled.
2. Two passes over the fit list give exact sums per dimension (DECIMAL) and the
   scatter of the centred vectors.  Tasks send one d x d matrix as rows, which
   are added up row by row on the cluster; the driver gets d numbers, then d rows.
3. On that matrix, whose size does not depend on the number of vectors: a
   Cholesky factor with diagonal pivoting, then one-sided Jacobi rotations of
   the factor's columns until all are orthogonal.  Squared column norms are the
   eigenvalues, normalised columns the components.  The covariance is never
   multiplied again, so small eigenvalues keep their digits.
4. One pass writes the whitened rows; one over the fit list measures how far
   the covariance of the whitened vectors is from the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colline.llm.common import save

SCALE, SHIFT = 64, 1_000_000
MOST_DIMENSIONS = 4096  # the matrix that reaches the driver has at most 128 MB
SWEEPS = 60
EXACT = 1 << 62  # below it 64-bit integers are used, beyond it Python's


def _whole(entries: np.ndarray) -> np.ndarray:
    """floor(64 c) + 1000000 of finite doubles; Python integers where 64 bits do not do."""
    x = np.floor(entries * SCALE)
    if x.size == 0 or np.abs(x).max() < EXACT:
        return x.astype(np.int64) + SHIFT
    return np.array([int(c) + SHIFT for c in x.ravel()], dtype=object).reshape(x.shape)


def _packed(x: np.ndarray) -> list[bytes]:
    """One byte string a row, the same for the same integers: 4 or 8 bytes an entry, else text."""
    most = np.abs(x).max(axis=1)
    if x.dtype == object:
        return [_packed(r.astype(np.int64)[None, :])[0] if m < EXACT else b"t" + ",".join(map(str, r)).encode() for r, m in zip(x, most)]
    return [b"i" + r.astype("<i4").tobytes() if m < 2**31 else b"q" + r.astype("<i8").tobytes() for r, m in zip(x, most)]


def _unpacked(rows: list[bytes]) -> np.ndarray:
    kinds, sizes = {r[:1] for r in rows}, {len(r) for r in rows}
    if len(kinds) == 1 and kinds != {b"t"} and len(sizes) > 1:
        raise ValueError("vectors of different lengths")
    if kinds == {b"i"}:
        return np.frombuffer(b"".join(r[1:] for r in rows), dtype="<i4").reshape(len(rows), -1).astype(np.int64)
    out = [
        [int(v) for v in r[1:].split(b",")] if r[:1] == b"t" else np.frombuffer(r[1:], dtype="<i4" if r[:1] == b"i" else "<i8").tolist()
        for r in rows
    ]
    return np.array(out, dtype=object if b"t" in kinds else np.int64)


def _usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(indices of the vectors without null or non-finite entries, their entries as doubles)."""
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    # without the entries of null lists; null entries become NaN
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    full = sizes > 0
    if not full.any():
        return np.empty(0, dtype=np.int64), np.empty((0, 0))
    starts = np.concatenate(([0], np.cumsum(np.maximum(sizes, 0))))[:-1][full]
    bad = np.add.reduceat((~np.isfinite(values)).astype(np.int64), starts) > 0
    good = np.flatnonzero(full)[~bad]
    if not len(good):
        return good, np.empty((0, 0))
    d = sizes[good]
    if d.min() != d.max():
        raise ValueError(f"vectors of different lengths ({d.min()} and {d.max()})")
    at = starts[~bad]
    return good, values[at[:, None] + np.arange(d[0])[None, :]]


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, entries = _usable(batch.column(0))
        if len(entries):
            yield pa.RecordBatch.from_pydict({"x": pa.array(sorted(set(_packed(_whole(entries)))), pa.binary())})


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            x = _unpacked(batch.column(0).to_pylist())
            part = [int(v) for v in (x.sum(axis=0) if _fits(x, len(x)) else x.astype(object).sum(axis=0))]
            if total is not None and len(total) != len(part):
                raise ValueError(f"vectors of different lengths ({len(total)} and {len(part)})")
            total = part if total is None else [a + b for a, b in zip(total, part)]
    if total is not None:
        yield pa.RecordBatch.from_pydict({"j": pa.array(range(len(total)), pa.int32()), "s": pa.array([str(v) for v in total])})


def _fits(x: np.ndarray, times: int) -> bool:
    return x.dtype != object and int(np.abs(x).max()) * times < EXACT


def deviations(x: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """n * x - S, exactly: 64-bit integers if they do, else Python's."""
    if _fits(x, n) and all(abs(s) < EXACT for s in sums):
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def centred(x: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """x - S/n, unrounded up to the last digits of a double: the integers are subtracted first."""
    return deviations(x, sums, n).astype(np.float64) / n


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """A factor G (d x r) with G G' = a for a positive semidefinite matrix of rank r.

    G is lower triangular up to the order of its rows; the largest remaining
    diagonal entry is the next pivot, and what is below rounding ends it.
    """
    d = len(a)
    rest, factor = np.diag(a).copy(), np.zeros((d, d))
    tiny = d * np.finfo(float).eps * max(rest.max(initial=0.0), 0.0)
    for k in range(d):
        p = int(np.argmax(rest))
        if not rest[p] > tiny:
            return factor[:, :k]
        column = (a[:, p] - factor[:, :k] @ factor[p, :k]) / np.sqrt(rest[p])
        column[rest == -np.inf] = 0.0  # rows of earlier pivots: the triangle's zeros
        factor[:, k] = column
        rest = np.where(rest == -np.inf, rest, rest - column * column)
        rest[p] = -np.inf
    return factor


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of ``factor @ factor.T``.

    Pairs of columns are rotated until all are orthogonal to working precision;
    a round rotates disjoint pairs at once, and each sweep's rounds meet every pair.
    """
    g = factor.T.copy()  # a row per column of the factor
    r = len(g)
    seats = np.arange(r + r % 2)  # the last seat is empty if r is odd
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(seats) - 1):
            i, j = seats[: len(seats) // 2], seats[::-1][: len(seats) // 2]
            seats = np.concatenate((seats[:1], seats[-1:], seats[1:-1]))
            real = (i < r) & (j < r)
            i, j = i[real], j[real]
            p, q, c = (np.einsum("ij,ij->i", a, b) for a, b in ((g[i], g[i]), (g[j], g[j]), (g[i], g[j])))
            off = np.divide(np.abs(c), np.sqrt(p * q), out=np.zeros_like(c), where=p * q > 0)
            worst = max(worst, off.max(initial=0.0))
            turn = off > 1e-16
            i, j, p, q, c = i[turn], j[turn], p[turn], q[turn], c[turn]
            z = (q - p) / (2.0 * c)
            t = np.where(z < 0, -1.0, 1.0) / (np.abs(z) + np.hypot(1.0, z))
            cos = (1.0 / np.hypot(1.0, t))[:, None]
            sin = cos * t[:, None]
            g[i], g[j] = cos * g[i] - sin * g[j], sin * g[i] + cos * g[j]
        if worst < 1e-15:
            break
    norms = np.einsum("ij,ij->i", g, g)
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] > 0]
    vectors = (g[order] / np.sqrt(norms[order])[:, None]).T
    largest = np.abs(vectors).argmax(axis=0) if vectors.size else np.empty(0, dtype=int)
    return norms[order], vectors * np.sign(vectors[largest, np.arange(vectors.shape[1])])


@dataclass
class Whitening:
    """Fitted components: ``n`` distinct vectors, their ``sums``, ``values`` (falling) and unit ``vectors``."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.sums, self.n) @ (self.vectors / np.sqrt(self.values))


def _added(rows: DataFrame) -> list:
    """Element-wise sums of the arrays ``row`` by ``i``: tasks keep one array for each of their i."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = row.values.to_numpy()
                held[i] = held[i] + v if i in held else v
        if held:
            yield pa.RecordBatch.from_pydict({"i": pa.array(list(held), pa.int32()), "row": pa.array([v.tolist() for v in held.values()], pa.list_(pa.float64()))})

    return rows.repartition("i").mapInArrow(add, "i int, row array<double>").collect()


def _gram(fit: DataFrame, left, d: int) -> np.ndarray:
    """Sum over the fit list of z z' for z = left(x), d entries each; the d rows meet on the driver."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                z = left(_unpacked(batch.column(0).slice(at, 2048).to_pylist()))
                total += z.T @ z
        if total.any():
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(d), pa.int32()), "row": pa.array(total.tolist(), pa.list_(pa.float64()))})

    out = np.zeros((d, d))
    for r in _added(fit.mapInArrow(task, "i int, row array<double>")):
        out[r["i"]] = r["row"]
    return out


def fit_whitening(embeddings: DataFrame, vector_col: str = "embedding", components: int = 16) -> Whitening:
    """The components of the distinct usable vectors (see :func:`whiten`)."""
    vectors = embeddings.select(F.col(vector_col).cast("array<double>").alias("v"))
    fit = save(vectors.mapInArrow(_distinct, "x binary").distinct(), "whitening-fit")
    n = fit.count()
    sums = fit.mapInArrow(_sums, "j int, s string").groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    s = np.array([int(v) for _, v in sorted(sums.collect())], dtype=object)
    d = len(s)
    if d > MOST_DIMENSIONS:
        raise ValueError(f"{d} dimensions; the covariance is held for at most {MOST_DIMENSIONS}")
    if not d:
        return Whitening(0, s, np.empty(0), np.empty((0, 0)), 0.0)
    covariance = _gram(fit, lambda x: centred(x, s, n), d) / n
    values, directions = one_sided_jacobi(pivoted_cholesky(covariance))
    model = Whitening(n, s, values[:components], directions[:, :components], float(np.trace(covariance)))
    k = len(model.values)
    if k:
        # the vectors are centred before they are projected, so the projections' sums are zero
        error = _gram(fit, model.project, k) / n - np.eye(k)
        model.identity_error = float(np.abs(error).max())
    return model


def whiten(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16,
    model: Whitening | None = None,
) -> tuple[DataFrame, Whitening]:
    """(``vec_id, deviation, whitened`` for every usable row, the fitted :class:`Whitening`).

    Every entry c becomes x = floor(64 c) + 1000000.  The fit list is each
    distinct x vector once; ``whitened`` holds the projections of x - S/n on the
    components of largest variance over their standard deviations, ``deviation``
    the exact sum of (n x - S)^2 (null where it does not fit a BIGINT).

    Null and empty vectors and those with null or non-finite entries are left
    out; vectors of different lengths raise.  A null id stays null; repeated
    rows give repeated rows and count once in the fit; other columns are not
    read.  Directions without variance are no components, so one distinct
    vector gives empty ``whitened``, and an empty table an empty result.  A
    component's largest entry is positive, which fixes its sign.
    """
    fitted = model or fit_whitening(embeddings, vector_col, components)
    schema = pa.schema([("vec_id", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, entries = _usable(batch.column(1))
            for at in range(0, len(good), 2048):
                x = _whole(entries[at : at + 2048])
                y = deviations(x, fitted.sums, fitted.n)
                if y.dtype == object or int(np.abs(y).max()) ** 2 * y.shape[1] >= EXACT:
                    y = y.astype(object)
                squares = (y * y).sum(axis=1).tolist()
                z = fitted.project(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(good[at : at + 2048])),
                        pa.array([v if v < 2**63 else None for v in squares], pa.int64()),
                        pa.array(z.tolist(), pa.list_(pa.float64())),
                    ],
                    schema=schema,
                )

    rows = embeddings.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "vec_id long, deviation long, whitened array<double>"), fitted


def whitened_rows(embeddings: DataFrame, components: int = 16) -> DataFrame:
    """One row per usable vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    rows, model = whiten(embeddings, components=components)
    # a share for each component: at most `components` numbers
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    out = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
        "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
