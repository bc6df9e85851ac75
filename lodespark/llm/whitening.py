"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Entries become whole numbers, so that counts, sums and sums of products are added up exactly in
any order. A pass over the rows gives the sums, a second one the products of the rows less their
mean rounded to whole numbers; what rounding left out is taken off exactly. The
driver gets matrices of the dimension only. There ``V = L L'`` with a triangular ``L`` in pivot
order, and rotations from the right make the columns of ``L`` orthogonal: their squared norms are
the eigenvalues, and the columns divided by their norms the eigenvectors, also where scales differ widely.

Defined cases: a row is left out if its vector is null or empty, holds a null, NaN or infinite
entry, or has another length than most rows (of equally frequent lengths the larger holds).
Numbers beyond 2 ** 61 count as that. Components end at the rank, so that fewer rows than
dimensions, or equal rows, give fewer of them, and equal rows alone none and no result. A
deviation beyond a long is null. Null and repeated ids and equal rows are kept as they come.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodespark.staging import spread

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
LARGEST = 2.0**61
# Bits of the parts that a long is cut into, so that a double holds sums of their products.
PART = 22
# A pivot is rounding noise below so many units in the last place of its first value, per dimension.
NOISE = 8
SWEEPS = 60


def vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and whole-number entries of the usable vectors of a batch, by their length."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten().fill_null(np.nan).to_numpy(zero_copy_only=False)
    stops = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    usable = (lengths > 0) & (bad[stops] == bad[stops - lengths])
    for length in np.unique(lengths[usable]):
        rows = np.flatnonzero(usable & (lengths == length))
        found = entries[(stops[rows] - length)[:, None] + np.arange(length)]
        whole = np.clip(np.floor(SCALE * found), -LARGEST, LARGEST).astype(np.int64)
        yield rows, whole + OFFSET


def sums(whole: np.ndarray) -> list[int]:
    """Exact sums of the columns."""
    if len(whole) * (int(np.abs(whole).max()) + 1) < 2**63:
        return whole.sum(axis=0).tolist()
    return whole.astype(object).sum(axis=0).tolist()


def products(whole: np.ndarray) -> np.ndarray:
    """Exact sums over the rows of the products of all columns, as Python numbers."""
    bits = int(np.abs(whole).max()).bit_length()
    cuts = max(1, -(-bits // PART))
    width = min(bits, PART)
    # Products of two parts and so many rows stay within the 53 bits of a double.
    rows = 1 << max(0, 53 - 2 * width)
    total = np.zeros((whole.shape[1],) * 2, object)
    for low in range(0, len(whole), rows):
        block = whole[low : low + rows]
        parts = [(block >> (PART * n)) & ((1 << PART) - 1) for n in range(cuts - 1)]
        parts = [p.astype(np.float64) for p in (*parts, block >> (PART * (cuts - 1)))]
        for a, left in enumerate(parts):
            for b, right in enumerate(parts):
                total += (left.T @ right).astype(np.int64).astype(object) * (1 << PART * (a + b))
    return total


def _added(partial: DataFrame) -> dict[int, list[int]]:
    """Sums of rows ``key, numbers`` by key: a task holds the lists of its keys, not the rows."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[int]] = {}
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                new = [int(x) for x in text.split(",")]
                old = held.get(key)
                held[key] = new if old is None else [a + b for a, b in zip(old, new)]
        yield _listed(held)

    rows = partial.repartition("key").mapInArrow(added, "key int, numbers string").collect()
    return {r["key"]: [int(x) for x in r["numbers"].split(",")] for r in rows}


def _listed(numbers: dict[int, list[int]]) -> pa.RecordBatch:
    texts = [",".join(map(str, some)) for some in numbers.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(numbers), pa.int32()), pa.array(texts, pa.string())], names=["key", "numbers"]
    )


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """Factor ``L`` with ``L L' = matrix``; its rows taken in pivot order are triangular.

    The pivot is the largest diagonal entry left; it ends at the rank, when each one left is noise
    next to what it was at first.
    """
    size = len(matrix)
    noise = NOISE * size * np.finfo(float).eps * matrix.diagonal()
    left = matrix.diagonal().copy()
    factor = np.zeros((size, size))
    open_ = np.ones(size, bool)
    for step in range(size):
        able = open_ & (left > noise)
        if not able.any():
            return factor[:, :step]
        pivot = int(np.where(able, left, -1.0).argmax())
        open_[pivot] = False
        root = np.sqrt(left[pivot])
        factor[pivot, step] = root
        below = (matrix[open_, pivot] - factor[open_, :step] @ factor[pivot, :step]) / root
        factor[open_, step] = below
        left[open_] -= below**2
    return factor


def one_sided_jacobi(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, falling, and directions of the columns after rotations that make them orthogonal.

    Each round rotates disjoint pairs of columns, dealt so that a sweep meets every pair once.
    """
    columns = factor.T.copy()
    size = len(columns)
    seats = np.arange(size + size % 2)  # an odd number of columns has one idle seat
    half = len(seats) // 2
    limit = np.finfo(float).eps * np.sqrt(max(1, factor.shape[0]))
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(seats) - 1):
            one, two = seats[:half], seats[half:][::-1]
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
            real = (one < size) & (two < size)
            one, two = one[real], two[real]
            p, q = columns[one], columns[two]
            a, b, c = (p * p).sum(1), (q * q).sum(1), (p * q).sum(1)
            off = np.abs(c) / np.sqrt(a * b)
            worst = max(worst, off.max(initial=0.0))
            turn = off > limit
            one, two, p, q = one[turn], two[turn], p[turn], q[turn]
            tau = (b[turn] - a[turn]) / (2 * c[turn])
            t = np.where(tau < 0, -1.0, 1.0) / (np.abs(tau) + np.hypot(1.0, tau))
            cos = (1 / np.hypot(1.0, t))[:, None]
            sin = cos * t[:, None]
            columns[one], columns[two] = cos * p - sin * q, sin * p + cos * q
        if worst <= limit:
            break
    norms = np.sqrt((columns * columns).sum(1))
    order = np.argsort(-norms, kind="stable")
    return norms[order], (columns[order] / norms[order, None])


@dataclass(frozen=True)
class Model:
    """Exact count and sums, and per component the unit vector, the eigenvalue and its share."""

    n: int
    total: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def centred(self, whole: np.ndarray) -> np.ndarray:
        """``n`` times the distance from the mean: exact."""
        bound = self.n * int(np.abs(whole).max()) + max(map(abs, self.total))
        if bound < 2**62:
            return self.n * whole - np.array(self.total, np.int64)
        return self.n * whole.astype(object) - np.array(self.total, object)

    def deviations(self, centred: np.ndarray) -> np.ndarray | list[int | None]:
        """Sums of squares of what ``centred`` gives; None beyond a long."""
        if centred.dtype != object and centred.shape[1] * int(np.abs(centred).max()) ** 2 < 2**63:
            return (centred * centred).sum(axis=1)
        exact = (centred.astype(object) ** 2).sum(axis=1)
        return [int(x) if x < 2**63 else None for x in exact]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """Coordinates of rows on the components, each with variance 1."""
        distance = (centred / self.n).astype(np.float64)
        return distance @ self.components.T / np.sqrt(self.values)


def fit(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Model | None:
    """The model of all usable vectors; None if they have no spread."""
    column = rows.select(F.col(vector).cast("array<double>").alias("vector"))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[int]] = {}
        for batch in batches:
            for found, whole in vectors(batch["vector"]):
                new = [len(found), *sums(whole)]
                old = held.get(whole.shape[1], [0] * len(new))
                held[whole.shape[1]] = [a + b for a, b in zip(old, new)]
        yield _listed(held)

    by_length = _added(spread(column).mapInArrow(totals, "key int, numbers string"))
    if not by_length:
        return None
    length = max(by_length, key=lambda size: (by_length[size][0], size))
    n, *total = by_length[length]
    middle = [(2 * s + n) // (2 * n) for s in total]

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((length, length), object)
        for batch in batches:
            for _, whole in vectors(batch["vector"]):
                if whole.shape[1] == length:
                    held += products(whole - np.array(middle, np.int64))
        yield _listed(dict(enumerate(held.tolist())))

    found = _added(spread(column).mapInArrow(scatter, "key int, numbers string"))
    left = [s - n * m for s, m in zip(total, middle)]
    # n * n times the covariance, exact; each entry is then rounded once.
    exact = [[n * q - a * b for q, b in zip(found[i], left)] for i, a in enumerate(left)]
    covariance = np.array([[x / (n * n) for x in row] for row in exact])
    norms, directions = one_sided_jacobi(pivoted_cholesky(covariance))
    if not len(norms):
        return None
    trace = sum(exact[i][i] for i in range(length)) / (n * n)
    values = norms[:components] ** 2
    return Model(n, total, directions[:components], values, values / trace)


def _moments(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, mean and centred products of the rows of some parts, from theirs."""
    n, mean, square = parts[0]
    for m, other, more in parts[1:]:
        away = other - mean
        square = square + more + np.outer(away, away) * (n * m / (n + m))
        mean, n = mean + away * (m / (n + m)), n + m
    return n, mean, square


_MOMENTS = "part int, n long, mean array<double>, square array<double>"


def identity_error(rows: DataFrame, model: Model, vector: str = "embedding") -> float:
    """Largest entry of the covariance of all whitened rows minus the identity, measured on them."""
    sent = rows.sparkSession.sparkContext.broadcast(vars(model))
    size = len(model.values)

    def row(part: int, moments) -> pa.RecordBatch:
        n, mean, square = moments
        return pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "n": [n], "mean": [mean.tolist()], "square": [square.ravel().tolist()]}
        )

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = Model(**sent.value), None
        for batch in batches:
            for _, whole in vectors(batch["vector"]):
                if whole.shape[1] == len(own.total):
                    found = own.whitened(own.centred(whole))
                    mean = found.mean(axis=0)
                    new = len(found), mean, (found - mean).T @ (found - mean)
                    held = new if held is None else _moments([held, new])
        if held is not None:
            yield row(TaskContext.get().partitionId(), held)

    def read(some) -> list[tuple[int, np.ndarray, np.ndarray]]:
        return [(n, np.array(mean), np.array(square).reshape(size, size)) for _, n, mean, square in some]

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = read(zip(*(c.to_pylist() for c in batch.columns)))
            if new:
                held = _moments([*([] if held is None else [held]), *new])
        if held is not None:
            yield row(TaskContext.get().partitionId(), held)

    column = spread(rows.select(F.col(vector).cast("array<double>").alias("vector")))
    tasks = column.mapInArrow(measured, _MOMENTS)
    # Parts of parts, in a fixed order: the driver gets about the root of their number.
    groups = max(1, int(column.rdd.getNumPartitions() ** 0.5))
    merges = tasks.repartition(groups, F.col("part") % groups).sortWithinPartitions("part")
    n, _, square = _moments(read(sorted(map(tuple, merges.mapInArrow(merged, _MOMENTS).collect()))))
    return float(np.abs(square / n - np.eye(size)).max())


def whiten(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each usable row
    and each of the first ``components`` components, numbered from 1."""
    kind = rows.schema[id].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double,"
        " identity_error double"
    )
    model = fit(rows, vector, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, model, vector)
    sent = rows.sparkSession.sparkContext.broadcast(vars(model))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**sent.value)
        size = len(own.values)
        for batch in batches:
            for found, whole in vectors(batch["vector"]):
                if whole.shape[1] != len(own.total):
                    continue
                centred = own.centred(whole)
                ids = batch["vec_id"].take(pa.array(np.repeat(found, size)))
                deviations = pa.array(own.deviations(centred), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(found))),
                        pa.array(np.full(len(ids), own.n)),
                        deviations.take(pa.array(np.repeat(np.arange(len(found)), size))),
                        pa.array(own.whitened(centred).ravel()),
                        pa.array(np.tile(own.explained, len(found))),
                        pa.array(np.full(len(ids), error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    picked = rows.select(F.col(id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return spread(picked).mapInArrow(told, schema)
