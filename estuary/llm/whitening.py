"""Embedding whitening by spectral divide and conquer.

Vectors become integers x = floor(64 c) + 1000000. The fit list holds every distinct
x vector once; its covariance (divisor n) is summed by Spark from partial products
of each task. The components are the eigenvectors of that covariance, found on the
driver by splitting its space again and again: the polar factor U of a shifted
covariance (QDWH iterations) gives the spectral projector (U + I) / 2 onto the
eigenvectors above the shift, whose range and complement are two smaller
problems. The components (at most ``COMPONENTS`` of them) and the mean go to the
tasks, which project every row.

Products are taken of x less its mean rounded to an integer: such sums are exact
integers (below 2^53), in whatever order tasks finish, and the part of the mean that
was rounded off is taken out afterwards as an exact rank-one term of at most 1/4.

Sizes: the driver holds d x d matrices for vectors of length d, a task one such
matrix; nothing there grows with the rows. The distinct list is one shuffle, with
repeated vectors merged before it.

Defined results: rows whose vector is NULL, empty or holds a NULL, NaN, infinity or
a magnitude above 2^40 take no part, and so do rows whose length is not the largest
one. vec_id is carried as it is, NULL and repeated ones included; repeated rows are
whitened each. Components without variance (eigenvalue up to d * 2^-52 of the
largest) are left out, so one distinct vector, or none, gives no rows. Equal
eigenvalues: any orthonormal basis of their space. ``deviation`` is NULL where it
exceeds a long. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estuary.llm.common import materialize

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
LARGEST = float(1 << 40)
_EPS = 2.0 ** -52


# ---- eigenvectors on the driver -----------------------------------------------------------------

def polar(a: np.ndarray, tol: float = 1e-15) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by QDWH iterations.

    Each step is a rational (Halley) function of the singular values with weights
    that follow a lower bound of the smallest, computed by a QR factorisation of
    [sqrt(c) X; I], which needs no inverse. The bound starts at rounding level: no
    decomposition of the matrix is needed to find a better one, and six steps or so
    are enough from there."""
    n = len(a)
    alpha = float(np.linalg.norm(a))
    if alpha == 0.0:
        return np.eye(n)
    x, low = a / alpha, 1e-16
    for _ in range(40):
        l2 = low * low
        dd = np.cbrt(4.0 * max(1.0 - l2, 0.0) / (l2 * l2))
        wa = np.sqrt(1.0 + dd) + 0.5 * np.sqrt(8.0 - 4.0 * dd + 8.0 * (2.0 - l2) / (l2 * np.sqrt(1.0 + dd)))
        wb = (wa - 1.0) ** 2 / 4.0
        wc = wa + wb - 1.0
        q, _ = np.linalg.qr(np.vstack((np.sqrt(wc) * x, np.eye(n))))
        new = (wb / wc) * x + ((wa - wb / wc) / np.sqrt(wc)) * (q[:n] @ q[n:].T)
        low = min(low * (wa + wb * l2) / (1.0 + wc * l2), 1.0)
        moved = np.linalg.norm(new - x)
        x = (new + new.T) / 2.0
        if moved <= np.cbrt(tol) and 1.0 - low < 1e-12:
            break
    # one Newton-Schulz step takes the factor to rounding
    return 1.5 * x - 0.5 * x @ (x.T @ x)


def _halves(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above and below ``shift``; None if one is empty."""
    n = len(a)
    above = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2.0
    k = int(round(float(np.trace(above))))
    if not 0 < k < n:
        return None
    # the columns of the projector with the largest norms that are left, then once more
    # through the projector: its range to rounding, whatever the columns were
    first = _pivots(above, k)
    q, _ = np.linalg.qr(above @ np.linalg.qr(above[:, first])[0])
    full, _ = np.linalg.qr(q, mode="complete")
    return q, full[:, k:]


def _pivots(p: np.ndarray, k: int) -> list[int]:
    """Columns that a pivoted Gram-Schmidt process takes first."""
    rest, out = p.copy(), []
    for _ in range(k):
        j = int(np.argmax((rest * rest).sum(0)))
        v = rest[:, j] / np.linalg.norm(rest[:, j])
        rest -= np.outer(v, v @ rest)
        out.append(j)
    return out


def eigenvectors(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix."""
    size = float(np.linalg.norm(v))
    values: list[float] = []
    columns: list[np.ndarray] = []
    todo = [((v + v.T) / 2.0, np.eye(len(v)))]
    while todo:
        a, basis = todo.pop()
        n = len(a)
        diagonal = np.sort(np.diag(a))
        off = float(np.linalg.norm(a - np.diag(np.diag(a))))
        if n == 1 or off <= 4 * _EPS * size:
            values += np.diag(a).tolist()
            columns += list(basis.T)
            continue
        found = None
        # a shift between two diagonal entries, the middle ones first, has eigenvalues on both
        # sides; the mean too, as long as they are not all equal
        middle = sorted(range(1, n), key=lambda i: abs(2 * i - n))
        for shift in [float(np.mean(diagonal)), *((diagonal[i - 1] + diagonal[i]) / 2.0 for i in middle)]:
            found = _halves(a, float(shift))
            if found is not None:
                break
        if found is None:  # all eigenvalues equal to rounding
            values += np.diag(a).tolist()
            columns += list(basis.T)
            continue
        for half in found:
            b = half.T @ a @ half
            todo.append(((b + b.T) / 2.0, basis @ half))
    vectors = np.stack(columns, 1)
    vectors = _refined(v, np.array(values), vectors)
    e = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-e, kind="stable")
    return e[order], vectors[:, order]


def _refined(v: np.ndarray, e: np.ndarray, q: np.ndarray) -> np.ndarray:
    """One first-order correction of the vectors for what is left off the diagonal, where
    two eigenvalues are clearly apart; then orthonormal again."""
    b = q.T @ v @ q
    gap = np.diag(b)[None, :] - np.diag(b)[:, None]
    far = np.abs(gap) > 1e-6 * max(float(np.abs(e).max()), 1e-300)
    turn = np.where(far, b / np.where(far, gap, 1.0), 0.0)
    np.fill_diagonal(turn, 0.0)
    q = q + q @ turn
    return q @ (1.5 * np.eye(len(q)) - 0.5 * q.T @ q)  # nearly orthonormal already: one step suffices


# ---- sums over the fit list ---------------------------------------------------------------------

def whole(vector: Column) -> Column:
    """x of a vector; NULL where it takes no part."""
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) <= LARGEST, F.lit(False)))
    return F.when(fine & (F.size(vector) > 0),
                  F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint") + OFFSET))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for b in batches:
        if not b.num_rows:
            continue
        x = _matrix(b.column("x"))
        # halves of 32 bits keep every partial sum of a batch inside a long
        part = [(int(h) << 32) + int(w) for h, w in zip((x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0))]
        total = part if total is None else [p + q for p, q in zip(total, part)]
        n += len(x)
    if n:
        yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()),
                               pa.array([str(t) for t in total])], names=["i", "n", "s"])


def _products(batches: Iterator[pa.RecordBatch], near: np.ndarray) -> Iterator[pa.RecordBatch]:
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        y = (_matrix(b.column("x")) - near).astype(np.float64)
        held = y.T @ y if held is None else held + y.T @ y
    if held is not None:
        i, j = np.triu_indices(len(held))
        yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(held[i, j])],
                              names=["i", "j", "v"])


def _gram(rows: DataFrame, d: int) -> np.ndarray:
    """Sum of the partial products (i, j, v): d (d + 1) / 2 numbers reach the driver."""
    t = rows.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((d, d))
    i, j, v = (t[c].to_numpy() for c in ("i", "j", "v"))
    out[i, j] = out[j, i] = v
    return out


@dataclass
class Whitening:
    """Mean (as n and sums), components and eigenvalues of a fit."""

    n: int
    sums: list[int]
    values: np.ndarray  # falling, as many as components
    vectors: np.ndarray  # d x components
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part of the mean is taken off in integers."""
        near = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - near).astype(np.float64) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact."""
        near = np.array([s // self.n for s in self.sums], np.int64)
        y = x - near  # n x - S = n y - (S mod n)
        most = (int(np.abs(y).max(initial=0)) + 1) * self.n
        if most * most * x.shape[1] < 1 << 63:
            z = y * self.n - np.array([s % self.n for s in self.sums], np.int64)
            return (z * z).sum(1).tolist()
        mod = [s % self.n for s in self.sums]
        exact = (sum((self.n * a - m) ** 2 for a, m in zip(row, mod)) for row in y.tolist())
        return [e if e < 1 << 63 else None for e in exact]


def fit_list(rows: DataFrame) -> DataFrame:
    """Every distinct x vector once, written to the shared folder."""
    return materialize(rows.select("x").distinct(), "whitening-fit")


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the rows of ``distinct`` (column x); None without any variance."""
    got = (distinct.mapInArrow(_sums, "i int, n bigint, s string").groupBy("i")
           .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect())
    if not got:
        return None
    n, sums = got[0].n, [int(r.s) for r in got]
    near = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    off = np.array([(s - int(m) * n) / n for s, m in zip(sums, near)])
    products = distinct.mapInArrow(lambda it: _products(it, near), "i int, j int, v double")
    v = _gram(products, len(sums)) / n - np.outer(off, off)
    e, q = eigenvectors(v)
    keep = min(components, int((e > len(e) * _EPS * max(float(e[0]), 0.0)).sum()))
    return Whitening(n, sums, e[:keep], q[:, :keep], float(np.trace(v))) if keep else None


def identity_error(distinct: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list less the identity."""
    k = len(w.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if b.num_rows:  # a column of ones carries the sums
                z = w.whitened(_matrix(b.column("x")))
                z = np.hstack((z, np.ones((len(z), 1))))
                held = z.T @ z if held is None else held + z.T @ z
        if held is not None:
            i, j = np.triu_indices(k + 1)
            yield pa.record_batch([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(held[i, j])],
                                  names=["i", "j", "v"])

    g = _gram(distinct.mapInArrow(run, "i int, j int, v double"), k + 1) / w.n
    mean = g[:k, k]
    return float(np.abs(g[:k, :k] - np.outer(mean, mean) - np.eye(k)).max())


_OUT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
        "identity_error double")


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per embedding that takes part and component: vec_id, component (from 1),
    n, deviation, whitened, explained and identity_error."""
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole(F.col("embedding")).alias("x"))
    rows = rows.where(F.col("x").isNotNull())
    d = rows.agg(F.max(F.size("x"))).first()[0]
    rows = rows.where(F.size("x") == F.lit(d or 0))
    distinct = fit_list(rows)
    w = fit(distinct, components)
    if w is None:
        return embeddings.sparkSession.createDataFrame([], _OUT)
    error = identity_error(distinct, w)
    k = len(w.values)
    explained = w.values / w.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("x"))
            m = len(x)
            yield pa.record_batch(
                [b.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, w.n)),
                 pa.array([v for v in w.deviation(x) for _ in range(k)], pa.int64()),
                 pa.array(w.whitened(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, _OUT)
