"""Principal components and whitened vectors by Chebyshev-filtered subspace iteration."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewatch.llm.kdtree import usable
from ratewatch.session import stored

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000

# Columns of the subspace beyond the wanted ones; passes of a filter; most rounds of all.
SPARE = 24
DEGREE = 8
ROUNDS = 40
SEED = 42

# Residuals, as a part of the largest eigenvalue, that count as converged, and below which a
# round without progress has reached the rounding of doubles.
CERTIFIED = 1e-14
ROUNDED = 1e-10

# Part of the largest eigenvalue below which a component has no variance.
NOTHING = 1e-12


def shifted(vector: str | Column) -> Column:
    """floor(1024 c) + 100000 of every entry; what does not fit a long is cut to its range."""
    far = 2.0**62
    return F.transform(
        vector,
        lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(far)), F.lit(-far))).cast("long") + SHIFT,
    )


def _rows(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dims).astype(float)


def _summed(vectors: DataFrame, of: Callable[[np.ndarray], np.ndarray], dims: int, shape: tuple[int, int]) -> np.ndarray:
    """The sum over all batches of what ``of`` makes of their rows, by place."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += of(_rows(batch, dims))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["place", "part"])

    made = vectors.select("x").mapInArrow(parts, "place long, part double")
    rows = made.groupBy("place").agg(F.sum("part").alias("total")).collect()
    out = np.zeros(shape[0] * shape[1])
    out[[r.place for r in rows]] = [r.total for r in rows]
    return out.reshape(shape)


def covariance_times(vectors: DataFrame, mean: np.ndarray, n: int) -> Callable[[np.ndarray], np.ndarray]:
    """A function that takes Q to V Q in one pass over all rows, centred before multiplying."""

    def times(q: np.ndarray) -> np.ndarray:
        def of(rows: np.ndarray) -> np.ndarray:
            centred = rows - mean
            return centred.T @ (centred @ q)

        return _summed(vectors, of, len(mean), q.shape) / n

    return times


def filtered(times: Callable, q: np.ndarray, bound: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial of V times Q that is small on [0, bound] and 1 at ``top``."""
    center = half = bound / 2
    sigma = first = half / (center - top)
    before, now = q, (times(q) - center * q) * (sigma / half)
    for _ in range(DEGREE - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (times(now) - center * now) * (2 * after / half) - sigma * after * before
        sigma = after
    return now


def eigenvectors(times: Callable, dims: int, count: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of V, falling, and their unit vectors as columns.

    Every round filters the subspace, makes it orthonormal and takes its Ritz vectors. They
    are certified when no wanted one leaves a residual beyond the bound, or when residuals of
    the size of rounding get no smaller.
    """
    count = min(count, dims)
    width = min(dims, count + SPARE)
    q = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, width)))[0]
    best = np.inf
    for _ in range(ROUNDS):
        image = times(q)
        inner = q.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        vectors = q @ turn
        rest = np.linalg.norm(image @ turn - vectors * values, axis=0)[:count].max()
        scale = max(values[0], np.finfo(float).tiny)
        if rest <= CERTIFIED * scale or (rest <= ROUNDED * scale and rest >= best / 2):
            return values[:count], vectors[:, :count]
        best = min(best, rest)
        bound = values[-1]
        # With all dimensions in the subspace, or no variance outside, there is nothing to damp.
        q = filtered(times, vectors, bound, values[0]) if width < dims and bound > 0 else image @ turn
        q = np.linalg.qr(q)[0]
    raise ArithmeticError(f"eigenvectors are not certified after {ROUNDS} rounds: residual {rest / scale:.2g}")


def whitened(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", count: int = COMPONENTS
) -> DataFrame:
    """Every vector on the ``count`` greatest principal components, scaled to variance 1.

    (vec_id, component, n, deviation, whitened, explained, identity_error): one row per vector
    and component, numbered from 1 by falling eigenvalue. Vectors are whole numbers
    x = floor(1024 c) + 100000; n counts them, ``deviation`` is the exact sum over dimensions
    of (n x - S)^2 with S the sums per dimension, or null beyond a long. ``explained`` is the
    eigenvalue's share of the whole variance, ``identity_error`` the largest entry of the
    covariance of ``whitened`` minus the identity.

    Vectors that are null, empty or hold a null or an entry that is not finite take no part.
    Shorter vectors have zero entries up to the longest. Repeated rows count, and give rows, as
    often as they are there; rows with a null id do too. Components without variance are left
    out, so equal vectors, a single one and an empty table give no rows. Of equal eigenvalues
    any unit vectors of their space are taken, the same for all rows.

    All rows are read once per pass of the iteration; a task gives a matrix of dimensions by
    columns of the subspace and these are summed by place, so only that matrix comes to the
    driver.
    """
    there = vectors.where(usable(vector_column) & (F.size(vector_column) > 0))
    rows = there.select(F.col(id_column).alias("vec_id"), shifted(vector_column).alias("x"))
    rows = stored(rows, "vectors")
    n, dims = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    kind = vectors.schema[id_column].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
    schema += "identity_error double"
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    filled = F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(dims) - F.size("x")))
    rows = rows.withColumn("x", filled)
    places = rows.select(F.posexplode("x").alias("place", "entry"))
    sums = dict(places.groupBy("place").agg(F.sum(F.col("entry").cast("decimal(20,0)"))).collect())
    sums = [int(sums[k]) for k in range(dims)]
    mean = np.array([s / n for s in sums])

    times = covariance_times(rows, mean, n)
    whole = _summed(rows, lambda x: ((x - mean) ** 2).sum(keepdims=True), dims, (1, 1)).item() / n
    values, axes = eigenvectors(times, dims, count)
    real = int((values > NOTHING * max(values[0], 0)).sum()) if values[0] > 0 else 0
    if not real:
        return vectors.sparkSession.createDataFrame([], schema)
    values, axes = values[:real], axes[:, :real]
    scaled = axes / np.sqrt(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred = _rows(batch, dims) - mean
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * real)
            made = pa.ListArray.from_arrays(offsets, pa.array((centred @ scaled).ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("vec_id", "deviation")), made], names)

    names = ["vec_id", "deviation", "z"]
    projected = rows.withColumn("deviation", _deviation(sums, n))
    projected = stored(projected.mapInArrow(project, f"vec_id {kind}, deviation long, z array<double>"), "whitened")
    pairs = [(i, j) for i in range(real) for j in range(i + 1)]
    covered = projected.agg(*(F.covar_pop(F.col("z")[i], F.col("z")[j]) for i, j in pairs)).first()
    error = max(abs(c - (i == j)) for c, (i, j) in zip(covered, pairs, strict=True))
    shares = F.array(*(F.lit(float(v / whole)) for v in values))
    long = projected.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
    return long.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )


def _deviation(sums: list[int], n: int) -> Column:
    """The sum over dimensions of (n x - S)^2 in whole numbers, null where it does not fit."""
    if max(map(abs, sums)) >= 2**63:
        return F.lit(None).cast("long")
    totals = F.array(*(F.lit(s).cast("long") for s in sums))

    def squared(x: Column, s: Column) -> Column:
        off = F.try_subtract(F.try_multiply(x, F.lit(n).cast("long")), s)
        return F.try_multiply(off, off)

    return F.aggregate(F.zip_with("x", totals, squared), F.lit(0).cast("long"), lambda a, b: F.try_add(a, b))
