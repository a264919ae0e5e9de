"""Whitening of embeddings from an exact scatter matrix.

Bit-sliced scatter: entries become whole numbers, each dimension is shifted to start at 0, and bit a of dimension i over
up to `ROWS` rows is packed into 64-bit words. The number of rows with bit a of i and bit b of j is the popcount of the
AND of both, and the sum of products is the sum of these counts times 2**(a+b): no rounding anywhere. Tasks keep counts
by a+b for all pairs of dimensions, Spark adds them by dimension, and the driver centres them as whole numbers,
n * sum(xi*xj) - sum(xi) * sum(xj), before the one eigendecomposition. What reaches the driver is
dimensions x dimensions x bits, however many rows there are; a task holds as much.

Whitened rows are stored, and the covariance that is held against the identity is that of the stored values.

Defined cases: rows whose vector is null, or holds a null, NaN or infinite entry, are left out; so are vectors whose
length is not the table's most frequent one (of equally frequent ones the longest). Numbers saturate at 2**62 either
way. Components without variance (eigenvalue not above rounding) have whitened 0 and are left out of the identity
error, which is 0 if no component is left; `explained` is 0 if there is no variance at all. A deviation beyond a long
is null. Rows with equal or null ids each count and are each returned. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
SATURATED = float(1 << 62)
#: Rows packed into words at a time, and words of one AND table.
ROWS, WORDS = 8192, 1 << 20
#: Partial covariances are merged in so many tasks before they reach the driver.
MERGERS = 16


def whole_numbers(vector: Column) -> Column:
    """floor(SCALE * c) + OFFSET of each entry."""

    def number(c: Column) -> Column:
        inside = F.least(F.greatest(c * F.lit(float(SCALE)), F.lit(-SATURATED)), F.lit(SATURATED))
        return F.floor(inside).cast("long") + F.lit(OFFSET).cast("long")

    return F.transform(vector.cast("array<double>"), number)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """`vec_id`, `x`: the rows that are fitted and returned, in whole numbers; vectors without entries are left out."""
    finite = F.forall(F.col("v"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    given = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = cut(given.where(finite).select("vec_id", whole_numbers(F.col("v")).alias("x")))
    size = F.size("x")
    usual = rows.groupBy(size.alias("size")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("size")).first()
    return rows.where((size == F.lit(usual["size"] if usual else 0)) & (size > 0))


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per dimension of a task: rows, sum, least and greatest number."""
    n, total, low, high = 0, None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch)
        near = int(np.abs(x.astype(np.float64)).max(initial=0.0)) * len(x) < 1 << 62
        added = x.sum(axis=0).astype(object) if near else x.astype(object).sum(axis=0)
        n += len(x)
        total = added if total is None else total + added
        low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
        high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
    if n:
        yield pa.RecordBatch.from_pydict(
            {
                "dim": pa.array(range(len(low)), pa.int32()),
                "n": pa.array([n] * len(low), pa.int64()),
                "total": pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)),
                "low": pa.array(low, pa.int64()),
                "high": pa.array(high, pa.int64()),
            }
        )


def bit_planes(y: np.ndarray, bits: int) -> np.ndarray:
    """bits x dimensions x words: bit a of each column of `y` (unsigned), one bit a row."""
    words = -(-len(y) // 64)
    planes = np.zeros((bits, y.shape[1], words * 8), dtype=np.uint8)
    for a in range(bits):
        packed = np.packbits(((y >> np.uint64(a)) & np.uint64(1)).astype(np.uint8).T, axis=1)
        planes[a, :, : packed.shape[1]] = packed
    return planes.view(np.uint64)


def add_products(counts: np.ndarray, planes: np.ndarray) -> None:
    """Adds popcounts of all pairs of planes to `counts` (weight a+b, dimension, dimension)."""
    bits, dims, words = planes.shape
    block = max(1, WORDS // max(1, dims * words))
    for a in range(bits):
        for b in range(a, bits):
            for first in range(0, dims, block):
                met = planes[a, first : first + block, None, :] & planes[b, None, :, :]
                found = np.bitwise_count(met).sum(axis=2, dtype=np.int64)
                counts[a + b, first : first + block] += found
                if a != b:
                    counts[a + b, :, first : first + block] += found.T


def _scatter(low: np.ndarray, bits: int):
    """Of a task: for each dimension the counts by weight against all dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            if not batch.num_rows:
                continue
            shifted = (_matrix(batch) - low).astype(np.uint64)
            counts = np.zeros((2 * bits - 1, len(low), len(low)), np.int64) if counts is None else counts
            for first in range(0, len(shifted), ROWS):
                add_products(counts, bit_planes(shifted[first : first + ROWS], bits))
        for i in range(len(low) if counts is not None else 0):
            yield pa.RecordBatch.from_pydict({"dim": pa.array([i], pa.int32()), "counts": pa.array([counts[:, i].tobytes()], pa.binary())})

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each dimension of a task: its counts added up."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, blob in zip(batch.column("dim").to_pylist(), batch.column("counts")):
            counts = np.frombuffer(blob.as_buffer(), dtype=np.int64)
            totals[i] = totals[i] + counts if i in totals else counts.copy()
    for i, counts in totals.items():
        yield pa.RecordBatch.from_pydict({"dim": pa.array([i], pa.int32()), "counts": pa.array([counts.tobytes()], pa.binary())})


@dataclass(frozen=True)
class Whitening:
    """n vectors with whole-number sums; unit components as columns, their eigenvalues and shares of the variance."""

    n: int
    sums: tuple[int, ...]
    low: np.ndarray
    high: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    @property
    def active(self) -> np.ndarray:
        """Components with variance above rounding."""
        least = len(self.sums) * np.finfo(float).eps * max(float(self.eigenvalues.max(initial=0.0)), 0.0)
        return self.eigenvalues > least


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Exact sums and scatter of `x`, and the eigenvectors of the covariance; None without rows."""
    moments = rows.select("x").mapInArrow(_moments, "dim int, n long, total decimal(38,0), low long, high long")
    found = moments.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))
    found = found.orderBy("dim").collect()  # a row per dimension
    if not found:
        return None
    n, dims = found[0]["n"], len(found)
    low = np.array([r["low"] for r in found], dtype=np.int64)
    high = np.array([r["high"] for r in found], dtype=np.int64)
    sums = tuple(int(r["total"]) for r in found)
    bits = max(1, max(int(h) - int(b) for h, b in zip(high, low)).bit_length())
    counted = rows.select("x").mapInArrow(_scatter(low, bits), "dim int, counts binary")
    scatter: list[list[int]] = [[]] * dims
    for row in counted.repartition("dim").mapInArrow(_added, "dim int, counts binary").collect():
        by_weight = np.frombuffer(row["counts"], dtype=np.int64).reshape(2 * bits - 1, dims).astype(object)
        scatter[row["dim"]] = sum(by_weight[s] * (1 << s) for s in range(2 * bits - 1)).tolist()
    # Sums of the shifted numbers; a shift changes no covariance.
    shifted = [s - n * int(b) for s, b in zip(sums, low)]
    centred = [[n * scatter[i][j] - shifted[i] * shifted[j] for j in range(dims)] for i in range(dims)]
    covariance = np.array([[c / (n * n) for c in row] for row in centred], dtype=np.float64)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[: min(components, dims)]
    trace = sum(centred[i][i] for i in range(dims)) / (n * n)
    explained = values[order] / trace if trace > 0 else np.zeros(len(order))
    return Whitening(n, sums, low, high, vectors[:, order], values[order], explained)


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """n * x - sums, exact: 64-bit where that is enough, whole numbers of any size otherwise."""
    reach = model.n * max(int(h) - int(b) for h, b in zip(model.high, model.low))
    shifted = [s - model.n * int(b) for s, b in zip(model.sums, model.low)]
    if reach < 1 << 62:
        return (x - model.low) * np.int64(model.n) - np.array(shifted, dtype=np.int64)
    return x.astype(object) * model.n - np.array(model.sums, dtype=object)


def _projected(model: Whitening):
    kinds = pa.schema([("vec_id", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])
    scale = np.where(model.active, np.sqrt(np.where(model.active, model.eigenvalues, 1.0)), np.inf)
    onto = model.components / scale
    widest = max(int(h) - int(b) for h, b in zip(model.high, model.low)) * model.n
    fits = len(model.sums) * widest * widest < 1 << 63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            centred = _centred(_matrix(batch), model)
            if fits:
                deviation = pa.array((centred * centred).sum(axis=1), pa.int64())
            else:
                exact = [sum(int(c) ** 2 for c in row) for row in centred]
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            white = (centred.astype(np.float64) / model.n) @ onto
            ends = pa.array(np.arange(len(white) + 1) * white.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviation, pa.ListArray.from_arrays(ends, pa.array(white.ravel()))], schema=kinds)

    return run


def _merge(a: tuple | None, b: tuple) -> tuple:
    """Rows, means and centred products of two parts together."""
    if a is None:
        return b
    n = a[0] + b[0]
    apart = b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def _covariances(size: int):
    def parts(batches: Iterator[pa.RecordBatch], read) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in read(batch):
                total = _merge(total, part)
        if total is not None:
            n, mean, products = total
            blob = np.concatenate(([float(n)], mean, products.ravel())).tobytes()
            yield pa.RecordBatch.from_pydict({"part": pa.array([blob], pa.binary())})

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        if batch.num_rows:
            white = _matrix(batch, "whitened")
            mean = white.mean(axis=0)
            yield len(white), mean, (white - mean).T @ (white - mean)

    def partials(batch: pa.RecordBatch) -> Iterator[tuple]:
        for blob in batch.column("part"):
            values = np.frombuffer(blob.as_buffer(), dtype=np.float64)
            yield values[0], values[1 : 1 + size], values[1 + size :].reshape(size, size)

    return lambda b: parts(b, rows), lambda b: parts(b, partials), partials


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """Largest entry of |covariance of the whitened rows - identity|, over components with variance."""
    size = len(model.eigenvalues)
    first, second, partials = _covariances(size)
    found = whitened.select("whitened").mapInArrow(first, "part binary").repartition(MERGERS).mapInArrow(second, "part binary").collect()
    total = None
    for row in found:  # at most MERGERS
        for part in partials(pa.RecordBatch.from_pydict({"part": pa.array([bytes(row["part"])], pa.binary())})):
            total = _merge(total, part)
    on = np.flatnonzero(model.active)
    if total is None or not len(on):
        return 0.0
    return float(np.abs((total[2] / total[0] - np.eye(size))[np.ix_(on, on)]).max())


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = usable(vectors, key, vector)
    model = fit(rows, components)
    names = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.eigenvalues):
        return vectors.sparkSession.createDataFrame([], names)
    white = cut(rows.mapInArrow(_projected(model), "vec_id long, deviation long, whitened array<double>"))
    error = identity_error(white, model)
    shares = F.array(*[F.lit(float(e)) for e in model.explained])
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
