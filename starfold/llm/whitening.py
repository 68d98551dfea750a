"""Whitening of vectors by refined eigenvectors of their distributed covariance.

Entries become whole numbers, so sums and deviations are exact. The covariance of the
distinct vectors is summed by the tasks, centred first; only its d x d numbers come to the
driver. There the eigenvectors are found in float32 and corrected in higher precision by
the iteration of Ogita and Aishima, which needs matrix products only and doubles the right
digits in each step. Eigenvalues that float32 cannot tell apart form a cluster; the step is
undefined inside one, so its subspace is solved as a smaller problem of its own, shifted by
the cluster's centre, where the gaps are large against the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.llm.common import stored
from starfold.session import ship_by_value

ship_by_value(__name__)

#: Components that are returned, at most.
COMPONENTS = 4
#: Whole numbers to a unit.
SCALE = 256
#: Sub-solves inside sub-solves, at most; each starts a factor of 2^23 below the last.
DEPTH = 4
#: Steps of one refinement, at most; from float32 three are enough.
STEPS = 8


# --- eigenvectors on the driver ------------------------------------------------------


def _clusters(value: np.ndarray, gap: float) -> list[np.ndarray]:
    """Places of the values in runs whose neighbours differ by at most ``gap``."""
    order = np.argsort(value)
    cuts = np.flatnonzero(np.diff(value[order]) > gap) + 1
    return np.split(order, cuts)


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Newton-Schulz steps towards the nearest orthonormal columns; products only."""
    for _ in range(STEPS):
        error = np.eye(x.shape[1], dtype=x.dtype) - x.T @ x
        x = x + x @ error / 2
        if np.abs(error).max() <= 8 * np.finfo(x.dtype).eps:
            break
    return x


def refine_step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One step of Ogita and Aishima: (better eigenvectors, eigenvalues, size of the step).

    Pairs of eigenvalues closer than the present error are only made orthogonal here.
    """
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    value = np.diag(s) / (1 - np.diag(r))
    norm = np.linalg.norm
    error = 2 * (norm((s - np.diag(value)).astype(float)) + norm(a.astype(float)) * norm(r.astype(float)))
    gap = value[None, :] - value[:, None]
    apart = np.abs(gap) > error
    e = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, value, float(np.abs(e).max())


def eigenvectors(a: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of a symmetric matrix to double precision, values falling.

    Products are taken in long double where the machine has one.
    """
    a = np.asarray(a, np.longdouble)
    size = float(np.abs(a).max()) if a.size else 0.0
    if len(a) < 2 or size == 0:
        return np.diag(a).astype(float), np.eye(len(a))
    a = (a + a.T) / (2 * size)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    x = _orthonormal(x)
    # What float32 cannot tell apart: its rounding error in an eigenvalue of this matrix.
    blur = 8 * len(a) * float(np.finfo(np.float32).eps)
    if depth:
        for _ in range(2):  # the second round starts from subspaces that the first has mended
            value = np.einsum("ij,ij->j", x, a @ x)
            for cluster in _clusters(value, blur):
                if 1 < len(cluster) < len(a) or (len(cluster) == len(a) and depth == DEPTH):
                    q = x[:, cluster]
                    centre = value[cluster].mean()
                    inner = q.T @ (a @ q) - centre * (q.T @ q)
                    x[:, cluster] = q @ eigenvectors(inner, depth - 1)[1].astype(np.longdouble)
            x, value, _ = refine_step(a, x)
    last = np.inf
    for _ in range(STEPS):
        better, value, step = refine_step(a, x)
        if step >= last:  # rounding is all that is left
            break
        x, last = better, step
    x = _orthonormal(x)
    value = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-value, kind="stable")
    return (value[order] * size).astype(float), x[:, order].astype(float)


# --- passes over the vectors ---------------------------------------------------------


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part.

    Rows with a null vector or a null or non-finite entry do not; neither do entries too
    large for a long, nor empty vectors. Of several lengths the most frequent one counts
    (of ties, the longer).
    """
    vector = F.col("embedding")
    fits = F.forall(
        vector,
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float(2**62 // SCALE)),
    )
    rows = stored(
        embeddings.where(vector.isNotNull())
        .where(fits & (F.size(vector) > 0))
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("x"),
        ),
        "whole-vectors",
    )
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("x") == most["d"]) if most else rows


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of one length as a matrix of longs."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _totals(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each dimension: sums of low and high halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0))
            n, low, high = n + len(x), low + (x & 0x7FFFFFFF).sum(0), high + (x >> 31).sum(0)
        yield pa.RecordBatch.from_pydict(
            {"dim": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()), "low": low, "high": high}
        )

    parts = fit.select("x").mapInArrow(run, "dim int, n long, low long, high long")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = parts.groupBy("dim").agg(F.sum("n").alias("n"), whole("low"), whole("high")).orderBy("dim").collect()
    return int(rows[0]["n"]) if rows else 0, [int(r["low"]) + (int(r["high"]) << 31) for r in rows]


def _second_moments(fit: DataFrame, mean: np.ndarray, basis: np.ndarray | None = None) -> np.ndarray:
    """Sum over the rows of v v^T, where v is the centred row, in a basis if one is given.

    Each task sends a matrix, row by row; rows of one number are added up by one task, so
    the driver gets one matrix whatever the number of tasks.
    """
    size = len(mean) if basis is None else basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            v = _matrix(batch.column(0)) - mean
            v = v if basis is None else v @ basis
            total += v.T @ v
        yield pa.RecordBatch.from_pydict(
            {"dim": pa.array(range(size), pa.int32()), "part": pa.array(total.tolist(), pa.list_(pa.float64()))}
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            parts = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
            for dim, part in zip(batch.column(0).to_pylist(), parts):
                sums[dim] = sums[dim] + part if dim in sums else part
        yield pa.RecordBatch.from_pydict(
            {
                "dim": pa.array(list(sums), pa.int32()),
                "part": pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64())),
            }
        )

    schema = "dim int, part array<double>"
    parts = fit.select("x").mapInArrow(run, schema).repartition("dim").mapInArrow(add, schema).collect()
    out = np.zeros((size, size))
    for row in parts:
        out[row["dim"]] = row["part"]
    return out


@dataclass
class Whitening:
    """What is learned from the distinct vectors; d and COMPONENTS bound its size."""

    n: int
    total: list[int]
    value: np.ndarray
    vector: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def mean(self) -> np.ndarray:
        return centre(self.n, self.total)


def centre(n: int, total: list[int]) -> np.ndarray:
    """Sums over n, each rounded once."""
    return np.array([s / n for s in total])


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening from a stored table of distinct vectors ``x``; None if it is empty."""
    first = fit.first()
    if first is None:
        return None
    n, total = _totals(fit, len(first["x"]))
    mean = centre(n, total)
    covariance = _second_moments(fit, mean) / n
    value, vector = eigenvectors(covariance)
    trace = float(np.trace(covariance))
    kept = min(components, len(value))
    value, vector = value[:kept], vector[:, :kept]
    # One of the two signs, the same in every run: the largest entry is positive.
    largest = vector[np.abs(vector).argmax(0), np.arange(kept)]
    vector = vector * np.where(largest < 0, -1.0, 1.0)
    real = value > 64 * np.finfo(float).eps * max(trace, 0.0)
    error = None
    if real.any():
        basis = vector[:, real] / np.sqrt(value[real])
        error = float(np.abs(_second_moments(fit, mean, basis) / n - np.eye(real.sum())).max())
    return Whitening(n, total, np.where(real, value, 0.0), vector, trace, error)


def _exact_deviation(x: np.ndarray, n: int, total: list[int]) -> pa.Array:
    """Sum over the dimensions of (n x - S)^2 for each row, as whole decimals."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, total))
    if most * most * max(x.shape[1], 1) < 1 << 62:
        away = n * x - np.array(total, np.int64)
        return pa.array((away * away).sum(1), pa.int64()).cast(pa.decimal128(38, 0))
    away = n * x.astype(object) - np.array(total, object)
    sums = (away * away).sum(1)
    return pa.array([s if s < 10**38 else None for s in sums], pa.decimal128(38, 0))


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error).

    One row for each row that takes part (see ``whole_vectors``) and each component;
    repeated rows and ids stay rows of their own. A component without variance has a null
    ``whitened``. ``deviation`` is exact, or null beyond 38 digits. Of equal eigenvalues
    any basis may come, the same for all rows. An empty table gives an empty result.
    """
    rows = whole_vectors(embeddings)
    fit = stored(rows.select("x").distinct(), "distinct-vectors")
    model = fit_whitening(fit, components)
    schema = (
        "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
        "explained double, identity_error double"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    kept, mean = len(model.value), model.mean
    root = np.sqrt(model.value)
    basis = np.where(root > 0, model.vector / np.where(root > 0, root, 1), np.nan)
    explained = model.value / model.trace if model.trace > 0 else np.zeros(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, m = _matrix(batch.column(1)), batch.num_rows
            if not m:
                continue
            each = np.repeat(np.arange(m), kept)
            projected = ((x - mean) @ basis).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * kept, model.n)),
                    _exact_deviation(x, model.n, model.total).take(pa.array(each)),
                    pa.array(projected, mask=np.isnan(projected)),
                    pa.array(np.tile(explained, m)),
                    pa.array([model.identity_error] * (m * kept), pa.float64()),
                ],
                names=names,
            )

    return rows.select("vec_id", "x").mapInArrow(run, schema)
