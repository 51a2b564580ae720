"""Embedding whitening: leading components by Chebyshev-filtered subspace iteration over distributed centred products."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hubcat.session import stored

#: A coordinate becomes the floor of so many times itself, a whole number.
SCALE = 256
#: Components that are returned, and columns of the iterated block beyond them.
COMPONENTS, GUARD = 4, 28
#: Degree of the filter's polynomial: passes between two Rayleigh-Ritz steps.
DEGREE = 8
#: Steps of the Lanczos runs that bound the spectrum from below.
LANCZOS = 12
#: A component is certified when its residual is this share of the largest eigenvalue.
CERTIFIED = 2e-14
#: Residual that must be reached; between the two, the iteration ends when rounding stops it.
ENOUGH = 1e-10
#: Filter rounds without an end; far more than any gap that doubles can tell needs.
MOST_ROUNDS = 500
#: An eigenvalue below this share of the trace counts as zero.
_NOTHING = 1e-13


class Whitening(NamedTuple):
    """What the fit list comes to: its length, exact sums by dimension, components (columns), eigenvalues, trace, and the error."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def mean(self) -> np.ndarray:
        return np.asarray([s / self.n for s in self.sums])


# Rows

def whole_vectors(rows: DataFrame, vector: str, *carried: Column) -> DataFrame:
    """The columns ``carried`` and ``x``, the vector in whole numbers, of the rows that take part.

    Null and empty vectors drop out, and those with a null or non-finite entry. A value beyond the range of a long
    becomes its end. Of several lengths the most frequent takes part (the smaller of equals).
    """
    v = F.col("vector")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    taken = rows.select(*carried, F.col(f"`{vector}`").cast("array<double>").alias("vector")).where(v.isNotNull() & (F.size(v) > 0) & finite)
    lengths = taken.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    made = taken.select(*(c for c in taken.columns if c != "vector"), F.transform(v, lambda c: F.floor(c * SCALE).cast("long")).alias("x"))
    return made if lengths is None else made.where(F.size("x") == lengths["d"])


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of whole numbers from an array column without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Many rows as one block of bytes: the passes read little else."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            block = _matrix(batch.column(0).slice(at, 4096))
            yield pa.RecordBatch.from_arrays([pa.array([len(block)], pa.int32()), pa.array([block.astype("<i8").tobytes()], pa.binary())], names=["rows", "block"])


# Passes over the fit list

def _summed(blocks: DataFrame, work, columns: int) -> np.ndarray:
    """The sum over all tasks of the matrices that ``work`` makes of a block, by their rows, in Spark.

    A task hands on one matrix, whose size is that of the dimensions; so does the driver get one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            for n, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                total = total + work(np.frombuffer(block.as_buffer(), "<i8").reshape(n, -1))
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), *(pa.array(np.ascontiguousarray(c)) for c in total.T)],
                                             names=["row", *(f"c{j}" for j in range(columns))])
    names = [f"c{j}" for j in range(columns)]
    made = blocks.mapInArrow(run, "row int, " + ", ".join(f"{c} double" for c in names))
    rows = made.groupBy("row").agg(*(F.sum(c).alias(c) for c in names)).collect()
    return np.asarray([r[1:] for r in sorted(rows)], "f8")


def exact_sums(blocks: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Rows of the fit list, and its sums by dimension, exact however large: high and low halves are added apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(block.as_buffer(), "<i8").reshape(n, -1)
                high, low = x >> 32, x & 0xFFFFFFFF
                yield pa.RecordBatch.from_arrays([pa.array(range(x.shape[1]), pa.int32()), pa.array([n] * x.shape[1], pa.int64()),
                                                  pa.array(high.sum(axis=0)), pa.array(low.sum(axis=0))], names=["dim", "n", "high", "low"])
    big = lambda c: F.sum(F.col(c).cast("decimal(28,0)")).alias(c)
    rows = sorted(blocks.mapInArrow(run, "dim int, n long, high long, low long").groupBy("dim").agg(F.sum("n").alias("n"), big("high"), big("low")).collect())
    return (rows[0]["n"] if rows else 0), tuple((int(r["high"]) << 32) + int(r["low"]) for r in rows)


class Covariance:
    """Products with the covariance of the fit list: each is one distributed pass, rows centred before they are multiplied."""

    def __init__(self, blocks: DataFrame, n: int, sums: tuple[int, ...]):
        self.blocks, self.n, self.mean, self.passes = blocks, n, np.asarray([s / n for s in sums]), 0

    def times(self, q: np.ndarray) -> np.ndarray:
        """V Q, as the sum of Xc' (Xc Q) over the blocks, by n."""
        self.passes += 1
        shared = self.blocks.sparkSession.sparkContext.broadcast((self.mean, q))

        def work(x: np.ndarray) -> np.ndarray:
            mean, q = shared.value
            centred = x - mean
            return centred.T @ (centred @ q)
        product = _summed(self.blocks, work, q.shape[1]) / self.n
        shared.destroy()
        return product

    def trace(self) -> float:
        mean = self.mean
        return float(_summed(self.blocks, lambda x: ((x - mean) ** 2).sum(axis=0)[:, None], 1).sum()) / self.n

    def whitened_error(self, components: np.ndarray, eigenvalues: np.ndarray) -> float:
        """The largest entry of the whitened fit list's covariance minus the identity; centred by its own mean, in a second pass."""
        mean, turn = self.mean, components / np.sqrt(eigenvalues)
        middle = _summed(self.blocks, lambda x: ((x - mean) @ turn).sum(axis=0)[:, None], 1).ravel() / self.n

        def work(x: np.ndarray) -> np.ndarray:
            w = (x - mean) @ turn - middle
            return w.T @ w
        return float(np.abs(_summed(self.blocks, work, turn.shape[1]) / self.n - np.eye(turn.shape[1])).max())


# The iteration

def lower_bound(v: Covariance, rng: np.random.Generator, steps: int = LANCZOS) -> float:
    """A value that the spectrum hardly goes below: smallest Ritz value of a short Lanczos run, less its residual; 0 at least."""
    d = len(v.mean)
    q = rng.normal(size=d)
    basis, alpha, beta = [q / np.linalg.norm(q)], [], []
    for _ in range(min(steps, d)):
        w = v.times(basis[-1][:, None])[:, 0]
        alpha.append(float(w @ basis[-1]))
        for _ in range(2):
            w = w - np.stack(basis, 1) @ (np.stack(basis, 1).T @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(alpha):
            break
        basis.append(w / beta[-1])
    off = beta[:len(alpha) - 1]
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(off, 1) + np.diag(off, -1))
    return max(0.0, float(values[0] - beta[-1] * abs(vectors[-1, 0])))


def chebyshev(v: Covariance, q: np.ndarray, vq: np.ndarray, low: float, high: float, largest: float, degree: int) -> np.ndarray:
    """The block under a polynomial of V that stays small on [low, high] and grows fast above; scaled to about 1 at ``largest``.

    ``vq`` is V Q, which the step before left over. Each further degree of the recurrence is one pass.
    """
    centre, half = (high + low) / 2, (high - low) / 2
    top = half / (largest - centre)
    sigma = top
    before, now = q, (vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        new = 1 / (2 / top - sigma)
        before, now = now, (v.times(now) - centre * now) * (2 * new / half) - sigma * new * before
        sigma = new
    return now


def leading_components(v: Covariance, wanted: int, guard: int = GUARD, degree: int = DEGREE, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns): filter, QR, Rayleigh-Ritz, until every residual is certified.

    The filter damps what lies between a lower bound of the spectrum and the smallest Ritz value of the
    block. A block that holds all dimensions needs no filter. Raises where rounding stops the iteration too early.
    """
    rng, d = np.random.default_rng(seed), len(v.mean)
    wanted, width = min(wanted, d), min(d, wanted + guard)
    q = np.linalg.qr(rng.normal(size=(d, width)))[0]
    low = lower_bound(v, rng) if width < d else 0.0
    best, stalled = np.inf, 0
    for _ in range(MOST_ROUNDS):
        vq = v.times(q)
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        worst = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max())
        scale = max(float(values[0]), 1e-300)
        if worst <= CERTIFIED * scale:
            break
        best, stalled = (worst, 0) if worst < best / 2 else (best, stalled + 1)
        if stalled >= 2 and best <= ENOUGH * scale:
            break
        high = float(values[-1])
        if width < d and high > low and float(values[0]) > high:
            q = chebyshev(v, q, vq, low, high, float(values[0]), degree)
        else:
            q = vq
        q = np.linalg.qr(q)[0]
    else:
        raise ArithmeticError(f"components not certified: residual {worst}")
    return values[:wanted], q[:, :wanted] / np.linalg.norm(q[:, :wanted], axis=0)


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the distinct vectors of a column ``x``. They are written once, in blocks; no vector comes to the driver."""
    blocks = stored(x.select("x").distinct().mapInArrow(_packed, "rows int, block binary"), "blocks")
    n, sums = exact_sums(blocks)
    if not n:
        return None
    v = Covariance(blocks, n, sums)
    trace = v.trace()
    if trace <= 0:
        d = len(sums)
        return Whitening(n, sums, np.eye(d)[:, :min(components, d)], np.zeros(min(components, d)), 0.0, None)
    values, vectors = leading_components(v, components)
    values = np.where(values > _NOTHING * trace, values, 0.0)
    some = values > 0
    return Whitening(n, sums, vectors, values, trace, v.whitened_error(vectors[:, some], values[some]))


# Results

def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None beyond the range of a long."""
    most = (1 << 63) - 1
    rough = ((x.astype("f8") * n - np.asarray(sums, "f8")) ** 2).sum(axis=1)
    safe = rough < 0.999 * most
    out: list[int | None] = [None] * len(x)
    if safe.any():
        small = n * x[safe] - np.asarray([s if abs(s) <= most else 0 for s in sums], "i8") if max(map(abs, sums)) <= most else None
        if small is not None and n <= most:
            for i, total in zip(np.flatnonzero(safe).tolist(), (small ** 2).sum(axis=1).tolist()):
                out[i] = total
            safe = ~safe
    for i in np.flatnonzero((rough < 1.001 * most) & [o is None for o in out]).tolist():
        total = sum((n * c - s) ** 2 for c, s in zip(x[i].tolist(), sums))
        out[i] = total if total <= most else None
    return out


def whiten(rows: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained, identity_error.

    Rows that take part are those of ``whole_vectors``; each gives a row per component, ``components`` or as many as there are
    dimensions. The fit is over the distinct vectors, so that copies weigh nothing, and needs no vector at the driver; what is
    broadcast has the size of dimensions times components. A component without variance has null for whitened, and
    is left out of the error (null where none has any); explained is null where there is no variance at all. A
    deviation that no long can hold is null. Rows that repeat an id, or have none, come back each. No usable row: no result.
    """
    taken = whole_vectors(rows, vector, F.col(f"`{vec_id}`").alias("vec_id"))
    id_type = dict(taken.dtypes)["vec_id"]
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = fit(taken, components)
    if found is None:
        return rows.sparkSession.createDataFrame([], schema)
    shared = rows.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        k = len(w.eigenvalues)
        some = w.eigenvalues > 0
        turn = w.components / np.sqrt(np.where(some, w.eigenvalues, 1.0))
        explained = [float(e / w.trace) if w.trace > 0 else None for e in w.eigenvalues]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            values = (x - w.mean) @ turn
            every = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype="i4"), len(x))), pa.array([w.n] * len(every), pa.int64()),
                pa.array(deviations(x, w.n, w.sums), pa.int64()).take(pa.array(every)), pa.array(values.ravel(), mask=np.tile(~some, len(x))),
                pa.array(explained * len(x), pa.float64()), pa.array([w.identity_error] * len(every), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return taken.mapInArrow(run, schema)
