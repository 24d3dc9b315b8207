"""Whitening of embeddings by shifted CholeskyQR.

Components become whole numbers; equal vectors count once. Their centred rows are a tall matrix X,
of which no more than a d x d Gram matrix leaves a task. Each pass sends the rows through the
triangular solves so far, Q = X R1^-1 R2^-1 ..., sums Q'Q over all tasks and takes its Cholesky
factor as the next R. The first factor is taken of the Gram matrix plus a small multiple of the
identity, so that it exists however ill conditioned X is; the next two bring Q to orthogonality.
X is then Q times the composed R, and the singular value decomposition of R holds the components
and their variances with the accuracy of QR, not of the squared matrix.

If components depend on each other, no pass makes Q orthogonal; a factor that doesn't exist is
then taken with the shift again, and the last Gram matrix is put into R by its square root.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationfield.llm.common import stored

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
PASSES = 3
#: Rows of a block that is solved at a time.
BLOCK_ROWS = 4096
#: Part of the largest standard deviation, for each dimension, that rounding alone may leave.
RANK_EPS = 1e-14
#: Whole numbers of at most this size are exact as doubles.
LARGEST = 1 << 53

WHITENED = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double"


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and x, the components as whole numbers, of the rows that take part.

    Left out are vectors that are null or empty or have null or non-finite components, components
    whose whole number is no exact double, and vectors of another length than most (of lengths
    equally frequent, the least stays). Ids may be null or repeat.
    """
    v = F.col("v")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float(LARGEST // SCALE - OFFSET)))
    rows = rows.where(v.isNotNull() & (F.size(v) > 0) & F.forall(v, fits))
    return rows.select("vec_id", F.transform(v, lambda c: F.floor(c * SCALE).cast("bigint") + OFFSET).alias("x"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, with the whole part taken off in whole numbers."""
    return (x - sums // n) - (sums % n) / n


def _solved(x: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """x R1^-1 R2^-1 ..., by forward substitution column by column."""
    for r in factors:
        q = np.empty_like(x)
        for j in range(x.shape[1]):
            q[:, j] = (x[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
        x = q
    return x


def _gram(fit: DataFrame, dim: int, rows_of, width: int | None = None) -> np.ndarray:
    """The sum of Y'Y over all rows, Y = rows_of(x), `width` columns. Each task sums its own; entries are then summed by Spark."""
    width = width or dim
    upper = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column("x"), dim)
            for a in range(0, len(x), BLOCK_ROWS):
                y = rows_of(x[a : a + BLOCK_ROWS])
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0])), pa.int32()), pa.array(total[upper])], ["entry", "value"])

    summed = fit.select("x").mapInArrow(run, "entry int, value double").groupBy("entry").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((width, width))
    entry = summed["entry"].to_numpy()
    out[upper[0][entry], upper[1][entry]] = summed["value"].to_numpy()
    return out + np.triu(out, 1).T


def _root(gram: np.ndarray) -> np.ndarray:
    values, axes = np.linalg.eigh(gram)
    return (axes * np.sqrt(np.maximum(values, 0))) @ axes.T


def composed_factor(fit: DataFrame, dim: int, n: int, sums: np.ndarray) -> np.ndarray:
    """R with X'X = R'R, X the centred rows of `fit`."""
    factors: list[np.ndarray] = []
    whole = np.eye(dim)
    shifted = False
    for k in range(PASSES):
        given = list(factors)
        gram = _gram(fit, dim, lambda x, given=given: _solved(_centred(x, n, sums), given))
        # the least shift for which rounding can't make the factor fail
        shift = 11 * (n * dim + dim * (dim + 1)) * np.finfo(float).eps * max(np.trace(gram), np.finfo(float).tiny)
        lower = None
        if k:
            try:
                lower = np.linalg.cholesky(gram)
                shifted = False
            except np.linalg.LinAlgError:
                lower = None
        if lower is None:
            lower, shifted = np.linalg.cholesky(gram + min(shift, np.trace(gram) or 1.0) * np.eye(dim)), True
        if k == PASSES - 1 and shifted:
            return _root(gram) @ whole
        factors.append(lower.T)
        whole = lower.T @ whole
    return whole


def components(fit: DataFrame, dim: int, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors of the covariance as columns, and their eigenvalues, falling; both of all `dim`."""
    _, sigma, axes = np.linalg.svd(composed_factor(fit, dim, n, sums))
    return axes.T, sigma**2 / n


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """Per row that takes part and component up to `most` (or the length of the vectors): vec_id, component,
    n, deviation, whitened, explained, identity_error.

    A component without variance (to working precision: constant or dependent vectors, or one
    distinct vector only) has `whitened` null and is left out of `identity_error`, which is 0 where
    no component is left; `explained` is 0 if nothing varies. A deviation that is too large for a long is
    null. Repeated rows each have their own result. No row that takes part gives an empty table.
    """
    spark = vectors.sparkSession
    rows = stored(whole_vectors(vectors, vec_id, embedding), "whole-vectors")
    sizes = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return spark.createDataFrame([], WHITENED + ", identity_error double")
    dim = sizes["dim"]
    rows = rows.where(F.size("x") == dim)
    fit = stored(rows.select("x").distinct(), "fit-vectors")
    n, sums = _sums(fit, dim)
    axes, e = components(fit, dim, n, sums)
    most = min(most, dim)
    varies = np.sqrt(e[:most]) > RANK_EPS * dim * np.sqrt(e[0])
    scale = np.where(varies, 1 / np.sqrt(np.where(varies, e[:most], 1.0)), np.nan)
    turned = axes[:, :most] * scale
    total = float(e.sum())
    explained = e[:most] / total if total > 0 else np.zeros(most)

    kept = turned[:, varies]
    error = 0.0
    if varies.any():
        covariance = _gram(fit, dim, lambda x: _centred(x, n, sums) @ kept, int(varies.sum())) / n
        error = float(np.abs(covariance - np.eye(len(covariance))).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(a, BLOCK_ROWS)
                x = _matrix(some.column("x"), dim)
                white = _centred(x, n, sums) @ turned
                row = np.repeat(np.arange(len(x)), most)
                values = white.ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("vec_id").take(pa.array(row)), pa.array(np.tile(np.arange(1, most + 1), len(x)), pa.int32()),
                        pa.array(np.full(len(row), n), pa.int64()), _deviation(x, n, sums).take(pa.array(row)),
                        pa.array(values, mask=np.isnan(values)), pa.array(np.tile(explained, len(x))),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained"],
                )

    return rows.mapInArrow(run, WHITENED).withColumn("identity_error", F.lit(error))


def _sums(fit: DataFrame, dim: int) -> tuple[int, np.ndarray]:
    """The number of vectors and the sum of each component, exactly: components are summed as decimals by Spark."""
    totals = fit.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("x", F.lit(j)).cast("decimal(20,0)")).alias(f"s{j}") for j in range(dim)]).first()
    n = totals["n"]
    exact = [int(totals[f"s{j}"]) for j in range(dim)]
    small = max(map(abs, exact)) < 1 << 62
    return n, np.array(exact, np.int64 if small else object)


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """The sum over components of (n x - sums)^2, exactly; null where it is no long."""
    base = sums // n
    near, rest = x - base, sums - n * base
    largest = (int(np.abs(near).max(initial=0)) + 1) * n
    if largest * largest * x.shape[1] < 1 << 63:
        return pa.array(((n * near - rest) ** 2).sum(axis=1).astype(np.int64))
    exact = ((n * near.astype(object) - rest) ** 2).sum(axis=1)
    return pa.array([d if d < 1 << 63 else None for d in exact.tolist()], pa.int64())
