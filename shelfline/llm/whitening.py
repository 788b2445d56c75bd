"""Whitening of vectors by shifted Cholesky QR.

The distinct vectors, centred, are a tall matrix A that Spark keeps in pieces. Each pass adds up the Gram matrix of what A has
become, factors it as R'R on the driver and goes on with A times the inverse of R, which tasks take row by row by a triangular
solve. The first factor is that of the Gram matrix plus a small multiple of the identity, which exists however badly
conditioned A is; the passes after it repair what the shift left, until the columns are orthonormal. The product R of all
factors has A's singular values and right singular vectors, which an SVD of this small matrix gives to working precision, where
the eigenvalues of A'A would have lost half of the digits. Only sums over tasks and d x d matrices reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.text import prepare
from shelfline.llm.vectors import lists, matrix, usable, whole_numbers
from shelfline.session import materialize

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
PASSES, ORTHONORMAL = 6, 1e-13
ROUNDING = np.finfo(np.float64).eps / 2
_INT64 = 1 << 62


@dataclass
class Whitening:
    """n and per-dimension sums of the fitted vectors; unit components in rows, their variances, the variance of all."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    passes: int
    error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n of whole numbers, rounded once."""
        return times_n_minus_sums(x, self.n, self.sums).astype(np.float64) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None where it is no long."""
        apart = times_n_minus_sums(x, self.n, self.sums)
        if apart.dtype == object or np.abs(apart.astype(np.float64)).max(initial=0) ** 2 * apart.shape[1] >= _INT64:
            found = [sum(int(v) ** 2 for v in row) for row in apart]
            return [v if v < 1 << 63 else None for v in found]
        return (apart * apart).sum(1).tolist()


def times_n_minus_sums(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S as whole numbers: 64-bit ones where these hold them, Python's elsewhere."""
    if n * (int(np.abs(x).max(initial=0)) + 1) < _INT64 and max(map(abs, sums), default=0) < _INT64:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular matrix, by forward substitution over its columns."""
    out = np.empty_like(rows)
    for j in range(upper.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def summed(vectors: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of `part` (of a matrix of whole vectors x) over all rows. Each task adds up its own; Spark adds up the tasks'."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(matrix(batch.column("x"), width))
                total = own if total is None else total + own
        if total is not None:
            yield pa.record_batch({"part": lists(total.reshape(1, -1))})

    parts = vectors.select("x").mapInArrow(work, "part array<double>")
    found = parts.select(F.posexplode("part").alias("place", "v")).groupBy("place").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(found))
    for row in found:
        out[row["place"]] = row["v"]
    return out


def whole_sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of vectors and their exact sums per dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), width)
            # Halves of the numbers, so that no sum over a batch leaves 64 bits.
            yield pa.record_batch({
                "n": pa.array([len(x)], pa.int64()), "high": lists((x >> 32).sum(0).reshape(1, -1)),
                "low": lists((x & 0xFFFFFFFF).sum(0).reshape(1, -1))})

    parts = vectors.select("x").mapInArrow(work, "n long, high array<long>, low array<long>")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found = parts.select("n", F.posexplode(F.arrays_zip("high", "low")).alias("place", "v")).select("n", "place", "v.*").groupBy("place").agg(
        exact("n"), exact("high"), exact("low")).collect()
    sums = [0] * width
    for row in found:
        sums[row["place"]] = (int(row["high"]) << 32) + int(row["low"])
    return (int(found[0]["n"]) if found else 0), sums


def fit(vectors: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of distinct whole-numbered vectors `x`; None if it has no row. Components whose variance is no
    more than rounding are left out, so there can be fewer than asked for, or none."""
    n, sums = whole_sums(vectors, width)
    if not n:
        return None
    model = Whitening(n, sums, np.zeros((0, width)), np.zeros(0), 0.0, 0)
    factors: list[np.ndarray] = []

    def gram(x: np.ndarray) -> np.ndarray:
        rows = model.centred(x)
        for factor in factors:
            rows = solved(rows, factor)
        return rows.T @ rows

    for step in range(PASSES):
        product = summed(vectors, width, gram).reshape(width, width)
        if not product.any():
            return model  # all vectors are equal
        if step and np.abs(product - np.eye(width)).max() <= ORTHONORMAL * width:
            break
        shift = 11 * (width * n + width * (width + 1)) * ROUNDING * np.trace(product)
        shift = min(shift, 1e-3 * np.trace(product))
        try:
            lower = np.linalg.cholesky(product + (0 if step else shift) * np.eye(width))
        except np.linalg.LinAlgError:  # columns without a share of their own
            lower = np.linalg.cholesky(product + 1e-10 * np.trace(product) / width * np.eye(width))
        factors.append(lower.T)
    whole = np.eye(width)
    for factor in factors:
        whole = factor @ whole
    _, values, vectors_t = np.linalg.svd(whole)
    real = values > values[0] * width * 1e-13
    take = min(components, int(real.sum()))
    variances = values**2 / n
    model = Whitening(n, sums, vectors_t[:take], variances[:take], float(variances[real].sum()), len(factors))
    if take:
        covariance = summed(vectors, width, lambda x: model.whitened(x).T @ model.whitened(x)).reshape(take, take) / n
        model.error = float(np.abs(covariance - np.eye(take)).max())
    return model


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, component (from 1, by falling variance), n, deviation, whitened, explained, identity_error: one row per usable row
    of `rows` and component.

    A row takes part if its `embedding` is not null, holds only finite numbers and has the most frequent length. Entries become
    floor(scale * entry) + offset, cut at 2^52 on both sides. Equal vectors count once in the fit; equal rows each get their
    rows; null ids are kept. There are no rows for a component without variance, so none at all for an empty table or for
    equal vectors only. `deviation` is null where it is no long. Other columns are not read.
    """
    spark = rows.sparkSession
    prepare(spark)
    found, width = usable(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"))
    whole = materialize(found.select(
        "vec_id", F.transform(whole_numbers("embedding", scale), lambda x: x + F.lit(offset).cast("long")).alias("x")), "whole_vectors")
    # The first half of this aggregate runs before the exchange: a vector that many rows have is sent once per task.
    model = fit(materialize(whole.select("x").distinct(), "distinct_vectors"), width, components)
    kind = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take = len(model.variances) if model else 0
        for batch in batches:
            if not take or not batch.num_rows:
                continue
            x = matrix(batch.column("x"), width)
            at = np.repeat(np.arange(len(x)), take)
            every = len(x) * take
            yield pa.record_batch({
                "vec_id": batch.column("vec_id").take(pa.array(at)),
                "component": pa.array(np.tile(np.arange(1, take + 1, dtype=np.int32), len(x))),
                "n": pa.array(np.full(every, model.n)),
                "deviation": pa.array(model.deviations(x), pa.int64()).take(pa.array(at)),
                "whitened": pa.array(model.whitened(x).ravel()),
                "explained": pa.array(np.tile(model.variances / model.trace, len(x))),
                "identity_error": pa.array(np.full(every, model.error))})

    return whole.mapInArrow(work, kind)
