"""Whitening of vectors by spectral divide and conquer.

The covariance of the distinct vectors is taken apart by matrix signs: the polar factor
of the covariance less a shift, found by the QR-based dynamically weighted Halley
iteration (QDWH), has the eigenvalue 1 where the covariance is above the shift and -1
below. Half its sum with the identity projects on the upper invariant subspace. Both
subspaces are split again, until they are single components, and the vectors are
projected on them in a last pass with the components broadcast.

The distinct vectors meet once, packed to the bytes that their numbers need. All else
that is shuffled are sums: a number for each dimension, and a row of the covariance for
each dimension and task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tricycle.llm.words import slices
from tricycle.plans import materialize

SCALE = 256
COMPONENTS = 4
# Whole numbers beyond it are cut to it: a double and a sum of 1024 are exact below.
LARGEST = 1 << 53
LONGEST = (1 << 63) - 1
_EPS = np.finfo(np.float64).eps
_WIDTHS = (np.int16, np.int32, np.int64)


# ---------------------------------------------------------------- components of a matrix


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix, by QDWH: a few steps ``x (a + b x²)
    (1 + c x²)⁻¹`` whose weights follow from a lower bound of the singular values.
    """
    n = len(a)
    x, low = a / max(np.linalg.norm(a), np.finfo(np.float64).tiny), _EPS
    for _ in range(12):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        p = np.sqrt(1 + d)
        wa = p + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * p))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:  # stable whatever the condition
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
            after = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            after = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(np.eye(n) + wc * (x.T @ x), x.T).T
        low = min(low * (wa + wb * low**2) / (1 + wc * low**2), 1.0)
        after = (after + after.T) / 2
        moved = np.linalg.norm(after - x)
        x = after
        if 1 - low < 10 * _EPS and moved < np.cbrt(5 * _EPS):
            break
    return x


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first columns span the invariant subspace above some
    shift, and how many they are; None where the eigenvalues are one to rounding.
    """
    n, rng = len(a), np.random.default_rng(5)
    spread = np.abs(a - np.diag(np.diag(a))).sum(axis=1)
    low, high = float((np.diag(a) - spread).min()), float((np.diag(a) + spread).max())
    shift = float(np.median(np.diag(a)))
    while high - low > 4 * n * _EPS * scale:
        upper = (np.eye(n) + polar_factor(a - shift * np.eye(n))) / 2
        k = int(round(np.trace(upper)))
        if 0 < k < n:
            basis = rng.normal(size=(n, n))
            for _ in range(3):
                basis, _ = np.linalg.qr(np.hstack([upper @ basis[:, :k], basis[:, k:] - upper @ basis[:, k:]]))
            if np.linalg.norm(basis[:, :k].T @ a @ basis[:, k:]) <= 20 * n * _EPS * scale:
                return basis, k
            # The shift is too close to an eigenvalue: any other one in between.
            shift = low + (high - low) * rng.uniform(0.05, 0.95)
            continue
        low, high = (shift, high) if k >= n else (low, shift)
        shift = low + (high - low) * 0.48
    return None


def spectral_components(a: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix, falling, and unit
    eigenvectors as columns. Subspaces below those are not taken apart.
    """
    scale = max(float(np.linalg.norm(a)), np.finfo(np.float64).tiny)
    values, vectors = [], []
    todo = [(a, np.eye(len(a)))]
    while todo and len(values) < count:
        part, basis = todo.pop()
        n = len(part)
        found = _split(part, scale) if np.abs(part - np.diag(np.diag(part))).max() > n * _EPS * scale else None
        if found is None:
            for k in np.argsort(-np.diag(part), kind="stable"):
                values.append(part[k, k])
                vectors.append(basis[:, k])
            continue
        q, k = found
        for columns in (q[:, k:], q[:, :k]):  # the upper one is taken next
            inner = columns.T @ part @ columns
            todo.append(((inner + inner.T) / 2, basis @ columns))
    columns = np.array(vectors[:count]).reshape(-1, len(a)).T
    columns = columns / np.linalg.norm(columns, axis=0)
    # Rayleigh quotients in the matrix itself.
    found = np.einsum("ik,ij,jk->k", columns, a, columns)
    order = np.argsort(-found, kind="stable")
    return found[order], columns[:, order]


# ---------------------------------------------------------------- sums over vectors


def _usable(vectors: DataFrame, column: str) -> DataFrame:
    """``(id, x)`` of the rows that take part."""
    x = F.col(column).cast("array<double>")
    finite = "forall(x, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('inf'))"
    return vectors.select(F.col("vec_id").cast("long").alias("id"), x.alias("x")).where(f"size(x) > 0 AND {finite}")


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    """Doubles as the whole numbers ``floor(scale * value)``."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * values), -LARGEST, LARGEST).astype(np.int64)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and a matrix for each length of the vectors in column ``x``."""
    x = batch.column("x")
    offsets = x.offsets.to_numpy()
    values, lengths = x.values.to_numpy(zero_copy_only=False), np.diff(offsets)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, values[offsets[rows][:, None] + np.arange(length)]


def _packed(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        if not batch.num_rows:
            continue
        keys, dims = [], []
        for _, values in _by_length(batch):
            whole = _whole(values, scale)
            most = np.abs(whole).max(axis=1)
            kind = (most > 32767).astype(int) + (most > 2147483647)
            for k, width in enumerate(_WIDTHS):
                keys += [bytes([k]) + row.tobytes() for row in whole[kind == k].astype(width)]
            dims += [values.shape[1]] * len(values)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(dims, pa.int32())], ["key", "dim"])


def _unpacked(keys: list[bytes]) -> np.ndarray:
    return np.array([np.frombuffer(k, _WIDTHS[k[0]], offset=1) for k in keys], np.int64)


def _dimension_sums(fits: DataFrame, dim: int) -> list[int]:
    """The sum of each dimension over the packed vectors, exact."""

    def add(batches):
        for batch in slices(batches):
            if batch.num_rows:
                total = _unpacked(batch.column("key").to_pylist()).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(total)], ["i", "total"])

    sums = fits.mapInArrow(add, "i int, total long").groupBy("i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {r.i: int(r.total) for r in sums.collect()}  # a row for each dimension
    return [found[i] for i in range(dim)]


def _covariance(fits: DataFrame, model: Whitening, projected: bool = False) -> np.ndarray:
    """Covariance of the centred packed vectors, or of their whitened components."""
    size = len(model.values) if projected else len(model.sums)

    def add(batches):
        total = np.zeros((size, size))
        for batch in slices(batches):
            if batch.num_rows:
                rows = model.centred(_unpacked(batch.column("key").to_pylist()))
                rows = model.project(rows) if projected else rows
                total += rows.T @ rows
        yield _matrix_rows(np.arange(size), total)

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column("i").to_pylist(), batch.column("row").to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(row)
        if sums:
            yield _matrix_rows(np.array([*sums]), np.array([*sums.values()]))

    merged = fits.mapInArrow(add, "i int, row binary").repartition("i").mapInArrow(merge, "i int, row binary")
    found = np.zeros((size, size))
    for r in merged.collect():  # a row for each dimension
        found[r.i] = np.frombuffer(r.row)
    return (found + found.T) / 2 / model.n


def _matrix_rows(numbers: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers.astype(np.int32)), pa.array([row.tobytes() for row in matrix], pa.binary())], ["i", "row"]
    )


# ---------------------------------------------------------------- the operator


@dataclass
class Whitening:
    """``n`` distinct vectors of whole numbers, their ``sums``, and their largest
    components: ``values``, and unit ``vectors`` as columns.
    """

    scale: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float = 0.0
    identity_error: float = 0.0

    def centred(self, whole: np.ndarray) -> np.ndarray:
        return whole - np.array([s / self.n for s in self.sums])

    def project(self, centred: np.ndarray) -> np.ndarray:
        return centred @ (self.vectors / np.sqrt(self.values))

    def deviations(self, whole: np.ndarray) -> list[int | None]:
        """The squared distance of ``n`` times each row from the sums, None beyond LONG."""
        most = self.n * int(np.abs(whole).max(initial=0)) + max(map(abs, self.sums))
        if whole.shape[1] * most**2 <= LONGEST:
            return ((self.n * whole - np.array(self.sums)) ** 2).sum(axis=1).tolist()
        found = [sum((self.n * x - s) ** 2 for x, s in zip(row, self.sums, strict=True)) for row in whole.tolist()]
        return [d if d <= LONGEST else None for d in found]


def fit(vectors: DataFrame, column: str = "embedding", count: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """The components of the distinct vectors ``floor(scale * x)``; None without any.

    Vectors have the length that most distinct ones have (of two, the larger one). A
    component of no variance, up to rounding, is none, so there may be fewer than
    ``count``. Only sums and a matrix of the size of a vector come to the driver.
    """
    usable = _usable(vectors, column)
    distinct = usable.select("x").mapInArrow(lambda b: _packed(b, scale), "key binary, dim int").distinct()
    distinct = materialize(distinct, "distinct-vectors")
    length = distinct.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if length is None:
        return None
    fits = distinct.where(F.col("dim") == length.dim).select("key")
    model = Whitening(scale, length["count"], _dimension_sums(fits, length.dim), np.empty(0), np.empty((length.dim, 0)))
    v = _covariance(fits, model)
    values, columns = spectral_components(v, min(count, length.dim))
    real = values > length.dim * _EPS * np.trace(v)
    model.values, model.vectors, model.trace = values[real], columns[:, real], float(np.trace(v))
    if real.any():
        whitened = _covariance(fits, model, projected=True)
        model.identity_error = float(np.abs(whitened - np.eye(len(whitened))).max())
    return model


def whitened(vectors: DataFrame, column: str = "embedding", count: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: a row
    for each row of ``vectors`` that takes part and each of the ``count`` largest
    components, numbered from 1.

    ``x = floor(scale * value)`` are the numbers that count; numbers beyond 2 ** 53 are
    cut to it. ``n`` distinct vectors ``x``, with the sums ``S``, have the covariance whose
    unit eigenvectors are the components. ``deviation`` is the sum of ``(n * x - S) ** 2``,
    null beyond LONG; ``whitened`` is ``x - S / n`` on the component over its standard
    deviation; ``explained`` is the component's share of the variance, and
    ``identity_error`` how far the covariance of the whitened distinct vectors is from
    the identity, at its worst entry.

    Null and empty vectors, vectors with null, infinite or NaN entries or of another
    length than most have no rows. Repeated rows count once for the components and have
    rows each; a null vec_id is kept. Components without variance have no rows, so one
    distinct vector or an empty table gives an empty result; which of the components of
    equal variance comes first is open, but the same for all rows. Other columns are
    ignored.
    """
    schema = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    model = fit(vectors, column, count, scale)
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    k, dim = len(model.values), len(model.sums)
    explained = model.values / model.trace

    def project(batches):
        for batch in slices(batches):
            for rows, values in _by_length(batch):
                whole = _whole(values, model.scale)
                repeated = np.repeat(rows, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(repeated)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(repeated), model.n)),
                        pa.array(model.deviations(whole), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                        pa.array(model.project(model.centred(whole)).ravel()),
                        pa.array(np.tile(explained, len(rows))),
                        pa.array(np.full(len(repeated), model.identity_error)),
                    ],
                    [part.split()[0] for part in schema.split(", ")],
                )

    return _usable(vectors, column).where(f"size(x) = {dim}").mapInArrow(project, schema)
