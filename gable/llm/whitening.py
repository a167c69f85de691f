"""Whitening of vectors by shifted Cholesky QR over distributed rows.

Entries are put on a lattice, floor(SCALE * entry) + OFFSET, so that sums, means and deviations are exact. With A the rows less
their mean, A = Q R, and the singular values and right vectors of the small R are those of A: e = singular value ** 2 / n are
the eigenvalues of the covariance, the right vectors its components. Forming the covariance itself would square A's
condition; the QR does not:

1. One pass sums the Gram matrix A' A; R1 is the Cholesky factor of it with a small shift on the diagonal, which always exists.
2. Two more passes solve A through the triangles found so far, which gives nearly orthogonal rows, sum their Gram matrix
   and take its factor, R2 and R3. R = R3 R2 R1.
3. A further pass measures the covariance of the whitened rows, for ``identity_error``; the last one writes them.

A pass sums matrices of dimension x dimension: within a task in memory, over tasks by a grouped sum over cells. The driver holds
a few of them, whatever the number of rows.

Rows whose vector is null, or holds null or non-finite entries or entries too large for exact lattice numbers (2**53), are
left out, as are vectors of another length than the commonest one (of equals the longest). Repeated rows and ids count and
are returned as often as they stand; null ids stay null. Directions without variance (eigenvalues at rounding's level, as
with equal or too few rows) have no component; where there is none, no rows are returned. A deviation beyond 64 bits is null.
Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gable.runtime import written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
LARGEST = 1 << 53
EPS = float(np.finfo(np.float64).eps)
#: Rows multiplied at a time, and rows of output in a batch.
ROWS, OUT_ROWS = 1 << 13, 1 << 16


def lattice(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, x (the vector on the lattice) and size of the rows that have a whole one."""
    rows = vectors.select(vectors[id_column].cast("long").alias("vec_id"), vectors[column].cast("array<double>").alias("v"))

    def run(batches):
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("v")))
            sizes = batch.column("v").value_lengths().to_numpy().astype(np.int64)
            flat = batch.column("v").flatten()
            scaled = np.floor(scale * flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
            with np.errstate(invalid="ignore"):
                bad = ~(np.abs(scaled) < LARGEST)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            whole = (np.bincount(owner, weights=bad, minlength=len(sizes)) == 0) & (sizes > 0)
            x = pa.array(scaled[whole[owner]].astype(np.int64) + offset)
            edges = pa.array(np.concatenate(([0], np.cumsum(sizes[whole]))).astype(np.int32))
            ids = batch.column("vec_id").filter(pa.array(whole))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(edges, x), pa.array(sizes[whole])], ["vec_id", "x", "size"])

    return rows.mapInArrow(run, "vec_id long, x array<long>, size long")


@dataclass
class Centre:
    """Rows n, whole numbers near the mean, and what the sums of rows less these leave."""

    n: int
    near: np.ndarray
    left: np.ndarray

    def whole(self, x: np.ndarray) -> np.ndarray:
        return x - self.near

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.whole(x).astype(np.float64) - self.left / self.n

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - sum) ** 2; null beyond 64 bits."""
        z = self.whole(x)
        top = self.n * (int(np.abs(z).max(initial=0)) + 1)
        if z.shape[1] * top * top < 1 << 63:
            far = self.n * z - self.left
            return pa.array((far * far).sum(axis=1))
        sums = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.left.tolist())) for row in z.tolist()]
        return pa.array([s if s < 1 << 63 else None for s in sums], pa.int64())


def _blocks(batches, size: int):
    """(ids, rows as a matrix) of at most ROWS rows."""
    for batch in batches:
        flat = batch.column("x").flatten().to_numpy().reshape(-1, size)
        for a in range(0, len(flat), ROWS):
            yield batch.column("vec_id")[a : a + ROWS], flat[a : a + ROWS]


def _summed(rows: DataFrame, matrix) -> np.ndarray:
    """Sum over tasks of a matrix that ``matrix`` makes of a task's batches."""

    def run(batches):
        found = matrix(batches)
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(found.size)), pa.array(found.ravel())], ["cell", "value"])

    kind = "long" if matrix.whole else "double"
    cells = rows.mapInArrow(run, f"cell long, value {kind}").groupBy("cell").agg(F.sum("value").alias("value"))
    out = np.zeros(matrix.cells, np.int64 if matrix.whole else np.float64)
    for cell, value in cells.collect():
        out[cell] = value
    return out


class _Sums:
    """The number of rows and, by dimension, their sums."""

    whole = True

    def __init__(self, size: int) -> None:
        self.size, self.cells = size, size + 1

    def __call__(self, batches):
        total = np.zeros(self.cells, np.int64)
        for _, x in _blocks(batches, self.size):
            total[0] += len(x)
            total[1:] += x.sum(axis=0)
        return total if total[0] else None


class _Gram:
    """The Gram matrix of the centred rows after solves through triangles and a projection."""

    whole = False

    def __init__(self, centre: Centre, triangles: list[np.ndarray], projection: np.ndarray | None = None) -> None:
        self.centre, self.triangles, self.projection = centre, triangles, projection
        self.width = len(centre.near) if projection is None else projection.shape[1]
        self.cells = self.width**2

    def __call__(self, batches):
        total = np.zeros((self.width, self.width))
        for _, x in _blocks(batches, len(self.centre.near)):
            a = self.centre.centred(x)
            for r in self.triangles:
                a = solve_right(a, r)
            if self.projection is not None:
                a = a @ self.projection
            total += a.T @ a
        return total


def solve_right(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a times the inverse of the upper triangle r, by substitution."""
    out = np.empty(a.shape, order="F")
    for j in range(len(r)):
        out[:, j] = (a[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def factor(gram: np.ndarray) -> np.ndarray:
    """A square root c of the Gram matrix, c' c = gram: the Cholesky factor, or one by eigenvalues where that does not exist."""
    try:
        return np.linalg.cholesky(gram).T
    except np.linalg.LinAlgError:
        values, vectors = np.linalg.eigh(gram)
        return np.sqrt(np.maximum(values, 0))[:, None] * vectors.T


@dataclass
class Whitening:
    """The mean, components (columns), their eigenvalues, the trace of the covariance, and the measured error."""

    centre: Centre
    components: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def projection(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)


def fit(rows: DataFrame, size: int, k: int = COMPONENTS) -> Whitening | None:
    """The whitening of lattice rows of one size; None if they do not vary."""
    sums = _summed(rows, _Sums(size))
    n, total = int(sums[0]), sums[1:]
    if not n:
        return None
    near = np.array([(2 * s + n) // (2 * n) for s in total.tolist()], np.int64)
    centre = Centre(n, near, np.array([s - n * c for s, c in zip(total.tolist(), near.tolist())], np.int64))

    gram = _summed(rows, _Gram(centre, [])).reshape(size, size)
    norm = float(np.linalg.eigvalsh(gram)[-1])
    if norm <= 0:
        return None
    # Rows are summed in blocks, so rounding follows the block's length rather than n.
    shift = 11 * (ROWS * size + size * (size + 1)) * (EPS / 2) * norm
    triangles = [np.linalg.cholesky(gram + shift * np.eye(size)).T]
    last = np.eye(size)
    for _ in range(2):
        gram = _summed(rows, _Gram(centre, triangles)).reshape(size, size)
        last = factor(gram)
        if not np.allclose(last, np.triu(last)) or np.diag(last).min() <= 0:
            break  # rank is missing: the square root is no triangle to solve through, but R is whole with it
        triangles.append(last)
    whole = last if last is not triangles[-1] else np.eye(size)
    for r in reversed(triangles):
        whole = whole @ r
    _, singular, right = np.linalg.svd(whole)
    values = singular**2 / n
    kept = min(k, int((singular > 100 * size * EPS * singular[0]).sum()))
    found = Whitening(centre, right[:kept].T.copy(), values[:kept], float(values.sum()))
    cov = _summed(rows, _Gram(centre, [], found.projection)).reshape(kept, kept) / n
    found.identity_error = float(np.abs(cov - np.eye(kept)).max())
    return found


def whitened(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """A row per row and component: vec_id, component, n, deviation, whitened, explained and identity_error."""
    share = fitted.values / fitted.trace

    def run(batches):
        kept = len(fitted.values)
        for ids, x in _blocks(batches, len(fitted.centre.near)):
            out, far = fitted.centre.centred(x) @ fitted.projection, fitted.centre.deviation(x)
            step = max(1, OUT_ROWS // kept)
            for a in range(0, len(x), step):
                b = min(len(x), a + step)
                row = pa.array(np.repeat(np.arange(a, b), kept))
                nth = np.tile(np.arange(kept), b - a)
                columns = [ids.take(row), pa.array((nth + 1).astype(np.int32)), pa.array(np.full(len(nth), fitted.centre.n)), far.take(row)]
                columns += [pa.array(out[a:b].ravel()), pa.array(share[nth]), pa.array(np.full(len(nth), fitted.identity_error))]
                yield pa.RecordBatch.from_arrays(columns, NAMES)

    return rows.mapInArrow(run, KIND)


NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
KIND = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, k: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """The first k whitened components of every row with a whole vector."""
    # Every pass reads the lattice rows.
    rows = written(lattice(vectors, id_column, column))
    commonest = rows.groupBy("size").count().orderBy(F.desc("count"), F.desc("size")).first()
    if commonest is not None:
        rows = rows.where(F.col("size") == commonest["size"]).select("vec_id", "x")
        fitted = fit(rows, commonest["size"], k)
        if fitted is not None:
            return whitened(rows, fitted)
    return rows.sparkSession.createDataFrame([], KIND)
