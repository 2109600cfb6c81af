"""Whitening of embeddings with components found by spectral divide and conquer.

The covariance of the distinct vectors is summed in tasks. Its eigenvectors come from
polar decompositions: the polar factor of ``A - shift`` is the difference of the spectral
projectors above and below the shift, and the ranges of the two projectors are split
again until single components are left (QDWH: the polar factor by dynamically weighted
Halley iteration, which needs only QR and Cholesky factors). The matrix, a row per
dimension, is small; it is worked on by the driver, and sent to the tasks that whiten.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from siltstone.llm.common import plain_names, slices, stored

EPS = float(np.finfo(float).eps)
#: Integer entries: ``floor(SCALE * c) + SHIFT``.
SCALE, SHIFT = 64, 1_000_000
#: Entries beyond are held at it, so that integers and doubles stay exact.
LARGEST = float(1 << 46)
#: Sums are kept as ``high * 2^LOW_BITS + low``, exact for any number of rows.
LOW_BITS = 24


# --- polar decomposition and spectral division ------------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH.

    ``lower`` bounds the least singular value of the scaled matrix from below. As long as
    it is small, the iteration's weight is large and the step is taken by a QR factor,
    which stays stable; later steps use a Cholesky factor.
    """
    n = len(a)
    x = a / (np.linalg.norm(a, "fro") or 1.0)
    # 1/(sqrt(n) |R^-1|) bounds it; a singular matrix gets the smallest bound of use.
    r = np.linalg.qr(x, mode="r")
    diagonal = np.abs(np.diag(r))
    lower = EPS
    if diagonal.min() > EPS:
        inverse = np.linalg.solve(r, np.eye(n))
        lower = max(EPS, 0.9 / (np.sqrt(n) * np.linalg.norm(inverse, 1)))
    eye = np.eye(n)
    for _ in range(40):
        square = lower * lower
        d = np.cbrt(4 * (1 - square) / (square * square)) if lower < 1 else 0.0
        wide = np.sqrt(1 + d)
        u = wide + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * wide), 0.0))
        v = (u - 1) ** 2 / 4
        w = u + v - 1
        if w > 100:
            q, _ = np.linalg.qr(np.concatenate([np.sqrt(w) * x, eye]))
            new = (v / w) * x + (u - v / w) / np.sqrt(w) * (q[:n] @ q[n:].T)
        else:
            half = np.linalg.cholesky(eye + w * (x.T @ x))
            new = (v / w) * x + (u - v / w) * np.linalg.solve(half.T, np.linalg.solve(half, x.T)).T
        lower = min(1.0, lower * (u + v * square) / (1 + w * square))
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x, "fro"), new
        if moved <= (10 * EPS) ** (1 / 3) and 1 - lower <= 10 * EPS:
            break
    return x


def _ranges(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Orthonormal bases of the subspaces above and below the shift, and how much of the
    matrix still couples them; None where all of the spectrum lies on one side."""
    n = len(a)
    projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = int(round(np.trace(projector)))
    if not 0 < rank < n:
        return None
    # Columns of largest remaining norm first, so that the leading ones span the range.
    left, order = projector.copy(), []
    for _ in range(rank):
        norms = np.einsum("ij,ij->j", left, left)
        norms[order] = -1.0
        k = int(np.argmax(norms))
        order.append(k)
        q = left[:, k] / (np.sqrt(norms[k]) or 1.0)
        left -= np.outer(q, q @ left)
    rest = [k for k in range(n) if k not in set(order)]
    basis, _ = np.linalg.qr(np.concatenate([projector[:, order], np.eye(n)[:, rest]], axis=1))
    # One more application of the projector makes the range exact to rounding.
    first, _ = np.linalg.qr(projector @ basis[:, :rank])
    second = np.linalg.qr(np.concatenate([first, basis[:, rank:]], axis=1))[0][:, rank:]
    return first, second, float(np.linalg.norm(second.T @ a @ first, "fro"))


def spectral_components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    A subspace on which the matrix is a multiple of the identity, up to rounding, is not
    split further: any of its orthonormal bases will do.
    """
    a = (a + a.T) / 2
    n, size = len(a), float(np.linalg.norm(a, "fro"))
    if n == 0:
        return np.zeros(0), np.zeros((0, 0))
    done, todo = [], [np.eye(n)]
    while todo:
        basis = todo.pop()
        block = basis.T @ a @ basis
        block = (block + block.T) / 2
        k, mean = len(block), float(np.trace(block)) / len(block)
        spread = float(np.linalg.norm(block - mean * np.eye(k), "fro"))
        if k == 1 or spread <= 4 * EPS * k * size:
            done.append(basis)
            continue
        best = None
        # The mean has part of the spectrum on either side. A shift that meets an
        # eigenvalue couples the two subspaces; another one is tried then.
        step = spread / np.sqrt(k)
        for shift in [mean + f * step for f in (0.0, 0.05, -0.05, 0.11, -0.11, 0.23, -0.23, 0.37, -0.37)]:
            found = _ranges(block, shift)
            if found is not None and (best is None or found[2] < best[2]):
                best = found
                if best[2] <= 8 * EPS * k * size:
                    break
        if best is None:
            done.append(basis)
            continue
        todo += [basis @ best[0], basis @ best[1]]
    vectors, _ = np.linalg.qr(np.concatenate(done, axis=1))
    vectors = _polished(a, vectors)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _polished(a: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """First-order correction of near eigenvectors: takes out what rounding of the many
    splits has left of one component in another."""
    for _ in range(2):
        inner = vectors.T @ a @ vectors
        values = np.diag(inner)
        gaps = values[None, :] - values[:, None]
        small = np.abs(gaps) <= 64 * EPS * max(float(np.abs(values).max()), 1e-300)
        turn = np.where(small | (np.abs(inner) > 0.01 * np.abs(gaps)), 0.0, inner / np.where(small, 1.0, gaps))
        np.fill_diagonal(turn, 0.0)
        vectors, r = np.linalg.qr(vectors + vectors @ turn)
        vectors = vectors * np.where(np.diag(r) < 0, -1.0, 1.0)
    return vectors


# --- sums over tables --------------------------------------------------------------


def integer_vectors(rows: DataFrame, vector: Column, keep: list[Column]) -> DataFrame:
    """``keep`` and ``x``, the integer vector, of rows whose vector is whole.

    Rows with a null vector, a null or non-finite entry, or no entry take no part.
    """
    v = vector.cast("array<double>")
    whole = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    )
    entry = lambda c: (
        F.floor(F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))).cast("bigint") + SHIFT
    )
    return rows.where(whole).select(*keep, F.transform(v, entry).alias("x"))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _summed(rows: DataFrame, partial, cells: int) -> np.ndarray:
    """Sum over all tasks of ``partial(matrices)``, an array of ``cells`` doubles.

    A task gives a row per cell, which Spark adds up; the driver gets the cells.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        used = False
        for batch in slices(batches, 4096):
            if batch.num_rows:
                total += partial(batch.column(0))
                used = True
        if used:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(cells)), pa.array(total)], names=["cell", "value"]
            )

    out = np.zeros(cells)
    found = rows.select("x").mapInArrow(sums, "cell long, value double").groupBy("cell").agg(F.sum("value"))
    for cell, value in found.collect():
        out[cell] = value
    return out


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: bounded by the dimension, whatever the number of rows."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        """Whole part and remainder apart, so that large sums lose nothing."""
        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums])
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return ((x - whole).astype(float) - rest) @ (self.vectors / np.sqrt(self.values))


def dimension_of(vectors: DataFrame) -> int:
    """The length that most vectors have, the larger one on ties; 0 without any."""
    lengths = vectors.groupBy(F.size("x").alias("d")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    return 0 if first is None else first["d"]


def fit(distinct: DataFrame, dimension: int, most: int) -> Whitening | None:
    """Components of a table ``x`` of distinct vectors of one length; None without rows.

    The table is read three times: for counts and sums (exact), for the covariance
    about the mean, and for that of the whitened vectors. Components of no variance, up
    to rounding, are left out: nothing can be scaled to them.
    """

    def counted(column: pa.Array) -> np.ndarray:
        x = _matrix(column, dimension)
        high = x >> LOW_BITS
        return np.concatenate([[len(x)], high.sum(0), (x - (high << LOW_BITS)).sum(0)]).astype(float)

    # Parts are below 2^53 for 2^29 vectors a task, and are added as decimals.
    found = _exact_sums(distinct, counted, 1 + 2 * dimension)
    n = found[0]
    if not n:
        return None
    sums = tuple((h << LOW_BITS) + low for h, low in zip(found[1 : 1 + dimension], found[1 + dimension :]))
    whole = np.array([s // n for s in sums])
    rest = np.array([(s % n) / n for s in sums])

    def scatter(column: pa.Array) -> np.ndarray:
        y = (_matrix(column, dimension) - whole).astype(float) - rest
        return (y.T @ y).ravel()

    covariance = _summed(distinct, scatter, dimension * dimension).reshape(dimension, dimension) / n
    values, vectors = spectral_components(covariance)
    trace = float(np.trace(covariance))
    rank = int((values > 4 * EPS * dimension * max(trace, 0.0)).sum()) if trace > 0 else 0
    k = min(most, rank)
    fitted = Whitening(n, sums, values[:k], vectors[:, :k], values[:k] / trace if trace else values[:k], 0.0)
    if not k:
        return fitted

    def whitened(column: pa.Array) -> np.ndarray:
        w = fitted.project(_matrix(column, dimension))
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    moments = _summed(distinct, whitened, k + k * k)
    mean = moments[:k] / n
    error = moments[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)
    return Whitening(n, sums, values[:k], vectors[:, :k], values[:k] / trace, float(np.abs(error).max()))


def _exact_sums(rows: DataFrame, partial, cells: int) -> list[int]:
    """Like ``_summed`` for whole numbers, which are added as such."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * cells
        for batch in slices(batches, 4096):
            if batch.num_rows:
                total = [a + int(b) for a, b in zip(total, partial(batch.column(0)))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(cells)), pa.array(list(map(str, total)))], names=["cell", "value"]
        )

    summed = rows.select("x").mapInArrow(sums, "cell long, value string").groupBy("cell").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    )
    out = [0] * cells
    for cell, value in summed.collect():
        out[cell] = int(value)
    return out


# --- the operator --------------------------------------------------------------------


def whiten(rows: DataFrame, fitted: Whitening, keep: list[str]) -> DataFrame:
    """``keep`` of each row of ``x`` and a row per component: ``component, n, deviation,
    whitened, explained, identity_error``.

    ``deviation`` is exact, and null where it does not fit into a long.
    """
    schema = rows.select(*keep).schema
    for name, kind in (("component", "integer"), ("n", "long"), ("deviation", "long"),
                       ("whitened", "double"), ("explained", "double"), ("identity_error", "double")):
        schema = schema.add(name, kind)
    types = [to_arrow_type(f.dataType) for f in schema.fields]
    dimension, k = len(fitted.sums), len(fitted.values)
    sums, n = np.array(fitted.sums, object), fitted.n

    def deviations(x: np.ndarray) -> list[int | None]:
        rough = (x - fitted.mean).astype(float) * n
        if (np.abs(rough).max() + n) ** 2 * dimension < 2.0**62 and max(map(abs, fitted.sums)) < 1 << 62:
            y = x * n - sums.astype(np.int64)
            return (y * y).sum(1).tolist()
        exact = [sum((int(c) * n - s) ** 2 for c, s in zip(row, fitted.sums)) for row in x.tolist()]
        return [e if e < 1 << 63 else None for e in exact]

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(len(keep)), dimension)
            m = len(x)
            at = pa.array(np.repeat(np.arange(m), k))
            columns = [c.take(at) for c in batch.columns[: len(keep)]]
            columns += [
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array([n] * (m * k), pa.int64()),
                pa.array(deviations(x), pa.int64()).take(at), pa.array(fitted.project(x).ravel()),
                pa.array(np.tile(fitted.explained, m)), pa.array([fitted.identity_error] * (m * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types)], names=schema.names)

    return rows.select(*keep, "x").mapInArrow(transform, schema)


def whitened_rows(table: DataFrame, folder: str, id_column: str = "vec_id", vector: str = "embedding",
                  most: int = 16) -> DataFrame:
    """Every row of ``table`` with a whole vector, whitened by up to ``most`` components.

    Components are fitted on each distinct integer vector once, so that copies, however
    many, weigh nothing; Spark combines copies within tasks before they meet. Vectors of
    another length than the most common one take no part. A null id stays null; repeated
    rows are rows of their own. Without a vector, or where all are equal, there is no
    component and no row comes out. Other columns, whatever their names, are not read.
    Entries beyond 2^46 / 64 are held at that.
    """
    rows, (key, values) = plain_names(table, id_column, vector)
    vectors = integer_vectors(rows, F.col(values), [F.col(key).alias(id_column)])
    dimension = dimension_of(vectors)
    vectors = vectors.where(F.size("x") == dimension)
    distinct = stored(vectors.select("x").distinct(), f"{folder}/distinct")
    fitted = fit(distinct, dimension, most) if dimension else None
    if fitted is None:
        fitted = Whitening(1, (0,) * dimension, np.zeros(0), np.zeros((dimension, 0)), np.zeros(0), 0.0)
    return whiten(vectors, fitted, [id_column])
