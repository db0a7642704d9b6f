"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors are put on a grid of integers, so that their sums are exact. The covariance ``V``
is never formed: one pass over the rows gives ``V Q = X'(X Q)/n`` of centred rows for a
block ``Q`` of columns, added up from partial sums of the partitions. A polynomial of
``V``, built by the Chebyshev recurrence from such passes, damps the eigenvalues below
the block's smallest Ritz value; then QR and Rayleigh-Ritz give the next block, until
the residuals certify the leading vectors.

The rows that are fitted, each distinct vector once, lie in a table as blocks of many
rows, so that a pass is a scan and two matrix products. Only matrices of ``dimensions x
columns`` reach the driver: partial sums are added in a tree, and at most ``FAN_IN`` of
them are fetched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm.tables import stage

COMPONENTS = 4
#: Columns of a block beyond the wanted ones; they widen the gap that the filter uses.
GUARD = 28
#: Passes of one filter.
DEGREE = 12
#: Grid points per unit.
SCALE = 256
#: Bytes of a block of rows.
BLOCK_BYTES = 1 << 21
#: Partial sums that one task, or the driver, adds up at a time.
FAN_IN = 64
#: A vector is certified if its residual is so small a share of its gap, or is rounding.
TOLERANCE, ROUNDING = 1e-13, 64 * np.finfo(float).eps
#: Rounds after which the iteration gives up with an error.
MOST_ROUNDS = 200


def _grid(vectors: DataFrame, embedding: str, vec_id: str) -> DataFrame:
    """``vec_id, x`` of the rows that remain."""
    own = F.col(embedding).cast("array<double>")
    finite = F.forall(own, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vectors.where(F.coalesce(finite, F.lit(False))).select(
        F.col(vec_id).alias("vec_id"),
        F.transform(own, lambda c: F.floor(c * F.lit(float(SCALE)))).alias("x"),
    )


def _padded(rows: DataFrame, dimensions: int) -> DataFrame:
    """Shorter vectors are filled up with zeros."""
    short = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dimensions) - F.size("x")))
    return rows.withColumn("x", F.when(F.size("x") < dimensions, short).otherwise(F.col("x")))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _pack(dimensions: int) -> Callable:
    most = max(1, BLOCK_BYTES // (8 * dimensions))

    def block(parts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"block": pa.array([np.concatenate(parts).astype("<i8").tobytes()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            x = _matrix(batch.column(0), dimensions)
            while len(x):
                part, x = x[: most - count], x[most - count :]
                held.append(part)
                count += len(part)
                if count == most:
                    yield block(held)
                    held, count = [], 0
        if count:
            yield block(held)

    return run


class FitList:
    """The rows that are fitted, and sums of arrays over their blocks."""

    def __init__(self, rows: DataFrame, dimensions: int):
        self.dimensions = dimensions
        packed = rows.select("x").distinct().mapInArrow(_pack(dimensions), "block binary")
        self.blocks = stage(packed, "fit-list")
        self.width = self.blocks.rdd.getNumPartitions()

    def sum(self, of: Callable[[np.ndarray], np.ndarray], dtype: type = float) -> np.ndarray | None:
        """The sum of ``of(block)`` over all blocks; None if there are none."""
        dimensions = self.dimensions

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return added(
                of(np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, dimensions))
                for batch in batches
                for raw in batch.column(0)
            )

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return added(np.frombuffer(raw.as_buffer(), dtype) for batch in batches for raw in batch.column(0))

        def added(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
            total = None
            for part in parts:
                total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_pydict({"total": pa.array([total.astype(dtype).tobytes()], pa.binary())})

        sums, width = self.blocks.mapInArrow(partial, "total binary"), self.width
        while width > FAN_IN:
            width = -(-width // FAN_IN)
            sums = sums.repartition(width).mapInArrow(merge, "total binary")
        found = [np.frombuffer(r[0], dtype) for r in sums.collect()]
        return np.sum(found, axis=0) if found else None


@dataclass(frozen=True)
class Whitening:
    """``n`` rows with ``sums``; eigenvectors of their covariance as columns, by falling
    eigenvalue, and its trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def found(self) -> np.ndarray:
        """Which components have an eigenvalue above rounding."""
        return positive(self.values, len(self.sums))


def positive(values: np.ndarray, dimensions: int) -> np.ndarray:
    return values > dimensions * np.finfo(float).eps * max(values.max(initial=0.0), 1e-300)


def _exact_sums(fit: FitList) -> tuple[int, list[int]]:
    """Rows and sums per dimension; high and low halves are added apart, so none overflows."""

    def of(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])

    found = fit.sum(of, np.int64)
    if found is None:
        return 0, [0] * fit.dimensions
    n, high, low = found[0], found[1 : 1 + fit.dimensions], found[1 + fit.dimensions :]
    return int(n), [(int(h) << 32) + int(w) for h, w in zip(high, low, strict=True)]


class Covariance:
    """``V Q`` by one pass over the rows that are fitted."""

    def __init__(self, fit: FitList, n: int, mean: np.ndarray):
        self.fit, self.n, self.mean, self.passes = fit, n, mean, 0

    def times(self, q: np.ndarray) -> np.ndarray:
        mean = self.mean

        def of(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return (centred.T @ (centred @ q)).ravel()

        self.passes += 1
        return self.fit.sum(of).reshape(q.shape) / self.n

    def trace(self) -> float:
        mean = self.mean

        def of(x: np.ndarray) -> np.ndarray:
            return ((x - mean) ** 2).sum(keepdims=True).ravel()

        return float(self.fit.sum(of)[0]) / self.n

    def of_projected(self, q: np.ndarray) -> np.ndarray:
        mean = self.mean

        def of(x: np.ndarray) -> np.ndarray:
            w = (x - mean) @ q
            return np.vstack([w.T @ w, w.sum(axis=0)]).ravel()

        total = self.fit.sum(of).reshape(-1, q.shape[1]) / self.n
        return total[:-1] - np.outer(total[-1], total[-1])


def chebyshev(times: Callable, q: np.ndarray, first: np.ndarray, below: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of the matrix, times ``q``: at most 1 on ``[0, below]`` and
    steep beyond it, scaled so that it is about 1 at ``top``. ``first`` is matrix times ``q``."""
    half = below / 2
    sigma = half / (top - half)
    two_over = 2 / sigma
    before, now = q, (first - half * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (two_over - sigma)
        before, now = now, 2 * (following / half) * (times(now) - half * now) - sigma * following * before
        sigma = following
    return now


def leading(
    times: Callable[[np.ndarray], np.ndarray],
    dimensions: int,
    wanted: int,
    guard: int = GUARD,
    degree: int = DEGREE,
    seed: int = 0,
) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, of a symmetric matrix without negative ones, and
    their unit vectors as columns; ``times`` gives the matrix times a block of columns.

    A vector is certified when its residual is at most ``TOLERANCE`` of the distance to
    the nearest other Ritz value, which bounds its error; where eigenvalues coincide, or
    rounding is reached and no round makes it smaller, when it is rounding alone.
    """
    columns = min(dimensions, wanted + guard)
    wanted = min(wanted, columns)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(dimensions, columns)))[0]
    best = np.inf
    for _ in range(MOST_ROUNDS):
        image = times(q)
        inner = q.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        residual = np.linalg.norm(image - q * values, axis=0)[:wanted]
        scale = max(values[0], np.finfo(float).tiny)
        gaps = np.abs(values[:wanted, None] - values[None, :])
        np.fill_diagonal(gaps, np.inf)
        gap = gaps.min(axis=1)
        worst = residual.max() / scale
        certified = (residual <= TOLERANCE * gap) | (residual <= ROUNDING * scale)
        stalled = worst > best / 2 and worst <= 1e-11
        if columns == dimensions or certified.all() or stalled or values[0] <= 0:
            vectors = q[:, :wanted]
            sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)])
            return np.maximum(values[:wanted], 0), vectors * sign
        best = min(best, worst)
        below = max(values[-1], 1e-6 * scale)
        q = np.linalg.qr(chebyshev(times, q, image, below, max(values[0], 1.001 * below), degree))[0]
    raise ArithmeticError(f"not certified after {MOST_ROUNDS} rounds: residual {worst:.3g} of the largest eigenvalue")


def fit(
    vectors: DataFrame, components: int = COMPONENTS, embedding: str = "embedding", vec_id: str = "vec_id"
) -> Whitening | None:
    """The leading components of the distinct grid vectors; None if there is no dimension.

    Rows whose vector is null or holds null or non-finite entries are left out; shorter
    vectors are filled up with zeros to the longest.
    """
    rows = _grid(vectors, embedding, vec_id)
    dimensions = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if not dimensions:
        return None
    fitted = FitList(_padded(rows, dimensions), dimensions)
    n, sums = _exact_sums(fitted)
    covariance = Covariance(fitted, n, np.array([s / n for s in sums]))
    trace = covariance.trace()
    values, q = leading(covariance.times, dimensions, components)
    kept = positive(values, dimensions)
    error = None
    if kept.any():
        found = covariance.of_projected(q[:, kept] / np.sqrt(values[kept]))
        error = float(np.abs(found - np.eye(len(found))).max())
    return Whitening(n, sums, q, values, trace, error, covariance.passes)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of ``(n x - S)**2`` of each row, exact; None where it is no 64-bit integer."""
    longest = n * max(float(np.abs(x).max(initial=0)), 1.0) + max(map(abs, sums), default=0)
    if longest < 2**62 and x.shape[1] * longest**2 < 2**62:
        return (((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1)).tolist()
    exact = (sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist())
    return [value if value < 2**63 else None for value in exact]


def whiten(vectors: DataFrame, model: Whitening | None, embedding: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """``vec_id, deviation, whitened`` of every row whose vector is whole and finite.

    ``whitened`` has one number per component: the centred grid vector projected on it,
    over the root of its eigenvalue; null where that is 0 (fewer distinct vectors or
    dimensions than components). ``deviation`` is the sum of ``(n x - S)**2``, null
    beyond 64 bits. Repeated rows give equal rows. An empty table, or one of empty
    vectors, gives none. Other columns are not looked at. A vector may not be longer than
    those that were fitted.
    """
    rows = _grid(vectors, embedding, vec_id)
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, deviation long, whitened array<double>"
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    n, sums, mean, dimensions = model.n, model.sums, model.mean, len(model.sums)
    scale = np.sqrt(np.where(model.found, model.values, np.nan))
    q = model.vectors / scale

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dimensions)
            w = (x - mean) @ q
            flat = pa.array(w.ravel(), pa.float64(), mask=np.isnan(w.ravel()))
            bounds = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(deviations(x, n, sums), pa.int64()),
                    pa.ListArray.from_arrays(bounds, flat),
                ],
                ["vec_id", "deviation", "whitened"],
            )

    return _padded(rows, dimensions).mapInArrow(run, schema)


def report(
    vectors: DataFrame, components: int = COMPONENTS, embedding: str = "embedding", vec_id: str = "vec_id"
) -> DataFrame:
    """One row per remaining row and component (numbered from 1): ``vec_id, component, n,
    deviation, whitened, explained, identity_error``; see ``fit`` and ``whiten``.

    There are as many components as asked for, or as there are dimensions if these are
    fewer. ``explained`` is the eigenvalue's share of the trace (0 if that is 0);
    ``identity_error`` is the largest absolute entry of the whitened rows' covariance minus
    the identity, over the components whose eigenvalue is above 0 (null if none is).
    """
    model = fit(vectors, components, embedding, vec_id)
    rows = whiten(vectors, model, embedding, vec_id)
    known = model or Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, None, 0)
    shares = [float(v / known.trace) if known.trace > 0 else 0.0 for v in known.values]
    explained = F.array(*map(F.lit, shares)) if shares else F.array().cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(known.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(known.identity_error).cast("double").alias("identity_error"),
    )
