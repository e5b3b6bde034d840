"""Whitening of embeddings: exact covariance, leading eigenpairs by Householder, Sturm counts and inverse iteration, projection."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import stored
from shelfwise.llm.vectors import exact_sums, integer_vectors, matrix

COMPONENTS, SHIFT = 8, 100_000
EPS = float(np.finfo(float).eps)
# Eigenvalues closer than this share of the matrix's norm are one cluster, whose vectors are kept orthogonal.
CLUSTER = 1e-3


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and orthogonal q with a = q t q', by one Householder reflection a column."""
    a, n = a.astype(float).copy(), len(a)
    q = np.eye(n)
    for j in range(n - 2):
        v = a[j + 1 :, j].copy()
        size = np.linalg.norm(v)
        if size == 0:
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        a[j + 1 :, :] -= 2 * np.outer(v, v @ a[j + 1 :, :])
        a[:, j + 1 :] -= 2 * np.outer(a[:, j + 1 :] @ v, v)
        q[:, j + 1 :] -= 2 * np.outer(q[:, j + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def sturm_counts(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each place of `at`, how many eigenvalues of the tridiagonal matrix are smaller."""
    least = max(float(np.max(off * off, initial=0.0)), 1.0) * np.finfo(float).tiny
    counts, pivot = np.zeros(len(at), int), np.ones(len(at))
    for i in range(len(diag)):
        pivot = diag[i] - at - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        counts += pivot < 0
    return counts


def largest_eigenvalues(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each halved down to neighbouring numbers of double precision."""
    n, around = len(diag), np.zeros(len(diag))
    around[1:] += np.abs(off)
    around[:-1] += np.abs(off)
    margin = 2 * EPS * n * (np.max(np.abs(diag) + around) + np.finfo(float).tiny)
    low, high = np.full(k, np.min(diag - around) - margin), np.full(k, np.max(diag + around) + margin)
    wanted = n - np.arange(1, k + 1)
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            return middle
        above = sturm_counts(diag, off, middle) > wanted
        low, high = np.where(above, low, middle), np.where(above, middle, high)


def _solve(diag: np.ndarray, off: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Solution of the tridiagonal system by elimination with row exchanges; a vanishing pivot becomes `least`."""
    n = len(diag)
    d, up, up2, x = diag.copy(), np.append(off, 0.0), np.zeros(n), b.copy()
    for i in range(n - 1):
        below = off[i]
        if abs(below) > abs(d[i]):
            factor = d[i] / below
            d[i], below_diag = below, d[i + 1]
            d[i + 1] = up[i] - factor * below_diag
            up[i], up2[i] = below_diag, up[i + 1]
            up[i + 1] = -factor * up[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
        else:
            d[i] = d[i] if abs(d[i]) >= least else np.copysign(least, d[i])
            factor = below / d[i]
            d[i + 1] -= factor * up[i]
            x[i + 1] -= factor * x[i]
    d[-1] = d[-1] if abs(d[-1]) >= least else np.copysign(least, d[-1])
    for i in range(n - 1, -1, -1):
        if i + 1 < n:
            x[i] -= up[i] * x[i + 1]
        if i + 2 < n:
            x[i] -= up2[i] * x[i + 2]
        x[i] /= d[i]
        top = np.max(np.abs(x[i:]))
        if top > 1e200:
            x /= top
    return x


def eigenvectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors, one a column, for falling eigenvalues, by inverse iteration from fixed starts.

    A vector whose eigenvalue is close to the one before it is made orthogonal to all vectors of that cluster in every
    step; equal eigenvalues are first moved apart by a few units of precision.
    """
    n, random = len(diag), np.random.default_rng(17)
    norm = float(np.max(np.abs(diag)) + 2 * np.max(np.abs(off), initial=0.0)) or 1.0
    vectors, first, shift = np.zeros((n, len(values))), 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            first = k
        shift = min(value, shift - 10 * EPS * norm) if k > first else value
        x, before = random.standard_normal(n), vectors[:, first:k]
        for _ in range(6):
            for _ in range(2):
                x = x - before @ (before.T @ x)
            x = _solve(diag - shift, off, x / np.linalg.norm(x), EPS * norm)
            x /= np.max(np.abs(x))
        for _ in range(2):
            x = x - before @ (before.T @ x)
        vectors[:, k] = x / np.linalg.norm(x)
    return vectors


def leading_eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    diag, off, q = tridiagonal(a)
    values = largest_eigenvalues(diag, off, min(k, len(diag)))
    vectors = q @ eigenvectors(diag, off, values)
    return values, vectors / np.linalg.norm(vectors, axis=0)


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, dims: int | None = None, shift: int = SHIFT,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """One row per usable vector: vec_id, n, deviation, whitened (array), explained (array), identity_error.

    Usable are vectors without null or non-finite components, of the length that most vectors have (`dims`, if given;
    of equally frequent lengths the larger); null vectors and all others give no row. Component c counts as
    x = floor(1024 * c) + shift. Sums, products and deviations are exact: products are taken after the whole part of
    the mean is taken off, and the fraction that is left is taken out of their sums in whole numbers. `deviation` is a
    decimal, as n * x - S outgrows 64 bits with n.

    A component without variance (eigenvalue within rounding of zero) cannot be whitened and is left out, so fewer than
    `components` may come back, none at all where all vectors are equal. Repeated rows and rows without an id count like
    any other; an empty table gives an empty result; other columns of the input are not read. What reaches the driver
    is dims * (dims + 1) sums; what is sent out is one matrix of dims * components.
    """
    spark = vectors.sparkSession
    if dims is None:
        sized = vectors.groupBy(F.size(embedding).alias("size")).count().filter("size > 0")
        most = sized.orderBy(F.desc("count"), F.desc("size")).first()
        dims = most["size"] if most else 0
    kept = integer_vectors(vectors, dims, vec_id, embedding, shift) if dims else None
    *sums, n = exact_sums(kept, dims, dims + 1, lambda x: np.append(x.sum(axis=0), len(x))) if dims else [0]
    id_type = vectors.schema[vec_id].dataType.simpleString()
    result = f"vec_id {id_type}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    if not n:
        return spark.createDataFrame([], result)

    whole, rest = [s // n for s in sums], [s % n for s in sums]
    centre = np.array(whole, np.int64)

    def products(x: np.ndarray) -> np.ndarray:
        y = x - centre
        return (y.T @ y).reshape(-1)

    raw = np.array(exact_sums(kept, dims, dims * dims, products), dtype=object).reshape(dims, dims)
    covariance = np.array([[(n * raw[i, j] - rest[i] * rest[j]) / (n * n) for j in range(dims)] for i in range(dims)], float)
    trace = sum(n * raw[i, i] - rest[i] * rest[i] for i in range(dims)) / (n * n)
    values, directions = leading_eigenpairs(covariance, components)
    real = values > dims * EPS * trace
    values, directions = values[real], directions[:, real]
    scaled, fraction = directions / np.sqrt(values), np.array([r / n for r in rest])
    rest_ints = np.array(rest, dtype=object)
    rest_squares = int((rest_ints * rest_ints).sum())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = matrix(batch, dims) - centre
            squares = (y * y).sum(axis=1).astype(object)
            # Products with the remainders, which are below n, stay inside 64 bits up to here.
            mixed = (y @ rest_ints.astype(np.int64)).astype(object) if n * dims < 1 << 37 else y.astype(object) @ rest_ints
            deviation = n * n * squares - 2 * n * mixed + rest_squares
            z = (y - fraction) @ scaled
            offsets = pa.array(range(0, z.size + 1, z.shape[1]) if z.shape[1] else [0] * (len(z) + 1), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), pa.array([Decimal(int(d)) for d in deviation], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(offsets, pa.array(z.reshape(-1), pa.float64())),
                ],
                names=["vec_id", "deviation", "whitened"],
            )

    projected = stored(kept.mapInArrow(project, f"vec_id {id_type}, deviation decimal(38,0), whitened array<double>"), "whitened")
    return projected.select(
        "vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(float(v) / trace) for v in values]).cast("array<double>").alias("explained"),
        F.lit(_identity_error(projected, len(values))).cast("double").alias("identity_error"),
    )


def _identity_error(projected: DataFrame, k: int) -> float:
    """Largest distance of an entry of the projections' covariance from the identity; 0 without components."""
    pairs = list(combinations_with_replacement(range(k), 2))
    if not pairs:
        return 0.0
    z = F.col("whitened")
    row = projected.agg(*[F.covar_pop(z[i], z[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
