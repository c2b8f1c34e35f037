"""Whitening of embeddings: distributed centred covariance, leading eigenpairs, broadcast projection.

Vectors become whole numbers first, so counts and sums are exact. The covariance is taken over the distinct vectors in
two passes: exact sums, then products of differences from the mean, summed up task by task. What comes to the driver is
one number for each pair of dimensions. Eigenpairs come from `tridiagonal.py`; the components travel with the projection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import column, stored
from quayside.llm.tridiagonal import EPS, leading_pairs
from quayside.llm.topk import usable

SCALE = 64.0
SHIFT = 1_000_000
# whole numbers up to here, and their differences, are exact as doubles
LARGEST = 1 << 52
_LOW_BITS = 26
_BATCH = 4096


@dataclass(frozen=True)
class Centre:
    """The mean of the fit list as exact numbers: sums / n = whole + rest / n, with 0 <= rest < n."""

    n: int
    sums: tuple[int, ...]

    def __post_init__(self):
        parts = [divmod(s, self.n) for s in self.sums]
        object.__setattr__(self, "whole", np.array([p[0] for p in parts], dtype=np.int64))
        object.__setattr__(self, "rest", np.array([p[1] for p in parts], dtype=np.int64))

    def differences(self, x: np.ndarray) -> np.ndarray:
        """x less the mean, as doubles; what is subtracted first is exact."""
        return (x - self.whole).astype(float) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """The exact sum over dimensions of (n * x - sums)^2 of every row."""
        apart = x - self.whole
        reach = int(np.abs(apart).max(initial=0)) + 1
        if (reach * self.n) ** 2 * x.shape[1] < 2**62:
            return ((self.n * apart - self.rest) ** 2).sum(axis=1).tolist()
        exact = self.n * apart.astype(object) - self.rest.astype(object)
        return [int((row * row).sum()) for row in exact]


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: the centre, unit components as rows, their eigenvalues and the share each explains."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre.differences(x) @ self.vectors.T / np.sqrt(self.values)


def whole_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE, shift: int = SHIFT
) -> DataFrame:
    """(id, x): every usable vector as the whole numbers floor(scale * c) + shift.

    Vectors that are null or empty, hold nulls or non-finite entries, or an entry whose number is beyond 2^52, take no
    part. Ids stay as they are, nulls and repeats included.
    """
    scaled = F.transform(column(vector_col), lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(shift))
    small = F.forall(column(vector_col), lambda c: F.abs(c.cast("double")) * scale + abs(shift) < float(LARGEST))
    fits = usable(column(vector_col)) & F.coalesce(small, F.lit(False)) & (F.size(column(vector_col)) > 0)
    return vectors.where(fits).select(column(id_col).alias("id"), scaled.alias("x"))


def _matrices(parts: Iterator[pa.RecordBatch], at: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with the vectors of column `at` as a matrix, some thousand rows at a time."""
    for whole in parts:
        for begin in range(0, len(whole), _BATCH):
            part = whole.slice(begin, _BATCH)
            flat = part.column(at).flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(len(part), -1).astype(np.int64)


def _centre(fit: DataFrame) -> Centre:
    """Number and exact sums of the fit list. Sums travel as high and low halves, which cannot overflow."""

    def partial(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for _, x in _matrices(parts):
            n += len(x)
            high = high + (x >> _LOW_BITS).sum(axis=0)
            low = low + (x & ((1 << _LOW_BITS) - 1)).sum(axis=0)
        if n:
            dims = np.arange(len(high))
            columns = [pa.array(c, pa.int64()) for c in (dims, np.full(len(dims), n), high, low)]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "n", "high", "low"])

    sums = fit.select("x").mapInArrow(partial, "i long, n long, high long, low long")
    found = sums.groupBy("i").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    rows = sorted(found.collect())
    return Centre(rows[0]["n"], tuple((r["high"] << _LOW_BITS) + r["low"] for r in rows))


def _second_moments(fit: DataFrame, made, size: int) -> np.ndarray:
    """The sum over the fit list of the products of each row's `size` values with each other; row `size` has their sums."""

    def partial(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((size + 1, size)), False
        for _, x in _matrices(parts):
            values = made(x)
            total[:size] += values.T @ values
            total[size] += values.sum(axis=0)
            seen = True
        if seen:
            i, j = np.nonzero(np.arange(size + 1)[:, None] >= np.arange(size))
            columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "value"])

    cells = fit.select("x").mapInArrow(partial, "i int, j int, value double")
    found = cells.groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()
    total = np.zeros((size + 1, size))
    total[found["i"], found["j"]] = found["value"]
    square = total[:size]
    square += np.tril(square, -1).T
    return total


def _covariance(moments: np.ndarray, n: int) -> np.ndarray:
    """Rows were centred before they were multiplied; what rounding left of their mean goes as well."""
    mean = moments[-1] / n
    return moments[:-1] / n - np.outer(mean, mean)


def fitted(rows: DataFrame, components: int = 16) -> Whitening | None:
    """The whitening of `rows` (id, x) by the distinct vectors among them; None without any variance.

    Vectors of another length than most distinct ones have (the longer one among equals) are not fitted. Components
    are those of non-zero variance, so there are fewer where the vectors span fewer dimensions.
    """
    fit = stored(rows.select("x").distinct(), "fit_list")
    lengths = fit.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return None
    size = most["size"]
    fit = fit.where(F.size("x") == size)
    centre = _centre(fit)
    covariance = _covariance(_second_moments(fit, centre.differences, size), centre.n)
    values, vectors = leading_pairs(covariance, components)
    trace = float(np.trace(covariance))
    real = values > 4 * size * EPS * max(trace, 0.0)
    if not real.any():
        return None
    values, vectors = values[real], vectors[real]
    whitening = Whitening(centre, values, vectors, values / trace, 0.0)
    moments = _second_moments(fit, whitening.project, len(values))
    error = np.abs(_covariance(moments, centre.n) - np.eye(len(values))).max()
    return Whitening(centre, values, vectors, values / trace, float(error))


SCHEMA = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whitened(
    vectors: DataFrame,
    components: int = 16,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """One row for each usable vector and component: its id, `component` from 1, `n`, `deviation`, `whitened`,
    `explained` and `identity_error`.

    Components are unit eigenvectors of the covariance of the distinct vectors, by falling eigenvalue, of either sign
    but the same for all rows. `deviation` is exact, as a decimal; null where it has more than 38 digits. Repeated rows
    are answered each time but count once in the fit. Empty tables, and vectors without any variance, give no rows;
    vectors of another length than the fitted ones give none either. Null ids are answered like others.
    """
    rows = whole_vectors(vectors, id_col, vector_col, scale, shift)
    whitening = fitted(rows, components)
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"`{id_col.replace('`', '``')}` {id_type}, {SCHEMA}"
    if whitening is None:
        return rows.sparkSession.createDataFrame([], schema)
    size, k = len(whitening.centre.sums), len(whitening.values)
    beyond = 10**38

    def project(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _matrices(parts, 1):
            m = len(part)
            exact = whitening.centre.deviations(x)
            deviations = pa.array([d if d < beyond else None for d in exact], pa.decimal128(38, 0))
            owners = pa.array(np.repeat(np.arange(m), k))
            columns = [
                part.column(0).take(owners),
                pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, whitening.centre.n), pa.int64()),
                deviations.take(owners),
                pa.array(whitening.project(x).ravel(), pa.float64()),
                pa.array(np.tile(whitening.explained, m), pa.float64()),
                pa.array(np.full(m * k, whitening.identity_error), pa.float64()),
            ]
            names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.where(F.size("x") == size).mapInArrow(project, schema)
