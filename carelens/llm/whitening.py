"""Whitening of vectors: FEAST contour integration on their covariance.

The covariance is summed exactly: components are whole numbers, each less the whole number next to its mean, so products
and sums are whole too and don't depend on how rows are dealt to tasks. It is a square matrix of the vectors' width, and
all that the solver needs.

Inertia counts come first: the covariance is brought to three diagonals, and the signs of the pivots of a shifted one
tell how many eigenvalues lie below the shift. Bisection with them places cuts in gaps of the spectrum, so that every
interval between two cuts has a few eigenvalues. Each interval is a task of its own. It solves systems of the complex
shifted covariance at the nodes of a quadrature of a circle around the interval; the weighted sum projects vectors onto
the interval's eigenvectors, and Rayleigh-Ritz extracts them; that is repeated until they are eigenvectors to double
precision. Last, what was found in an interval is compared with the difference of the inertia counts at its cuts, so a
missed eigenvalue is an error and not a missing component.

Defined cases. Vectors that are null or hold null or non-finite entries take no part. Vectors of different lengths are
taken as if the shorter ended in zeros. Entries beyond 2 ** 52 are set to that. Eigenvalues that rounding can't tell from
zero have no component: nothing varies there; so equal vectors only, or a single one, give no rows. A deviation beyond 64
bits is set to the largest number. Rows without an id or with the same id are transformed each. Ties of eigenvalues keep
any orthogonal directions, the same for all rows. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.store import stored

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
LARGEST = float(1 << 52)
#: Nodes of the quadrature on the upper half of the circle, and eigenvalues of an interval, about.
NODES, INTERVAL = 8, 6
#: Refinements of the subspace before the solver gives up, and residual it stops at, as a share of the largest eigenvalue.
ROUNDS, RESIDUAL = 80, 2e-14
#: Eigenvalues below this share of the largest are taken for zero, and closer ones than this for equal.
ZERO, TIE = 1e-11, 1e-9
SEED = 11
#: Vectors handled at once.
ROWS = 4096


def whole(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and the entries rounded down, of rows that take part; the shift is added where it is needed."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    bounded = lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale).cast("double"), F.lit(LARGEST)), F.lit(-LARGEST))
    entries = F.transform("embedding", lambda x: bounded(x).cast("long"))
    return vectors.where(F.coalesce(sound, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), entries.alias("entries"))


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    lengths = column.value_lengths().to_numpy()
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            yield matrix(batch.column("entries").slice(begin, ROWS), width)


def _added(a: list[int], b: list[int]) -> list[int]:
    return [x + y for x, y in zip(a, b, strict=True)]


def _total(rows: DataFrame, of, zero: list) -> list:
    """The sum of ``of(batches)``, a list of numbers, over all partitions, by a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([[str(x) for x in of(batches)]], pa.list_(pa.string()))], ["part"])

    kind = type(zero[0]) if zero else int
    parts = rows.mapInArrow(run, "part array<string>").rdd.map(lambda row: [kind(x) for x in row.part])
    return parts.treeAggregate(zero, _added, _added)


@dataclass
class Moments:
    """How many vectors there are, the sum of the shifted entries per dimension, and the covariance."""

    n: int
    sums: list[int]
    covariance: np.ndarray


def exact_products(rows: np.ndarray) -> np.ndarray:
    """Sums of products of the columns, in whole numbers."""
    most = int(np.abs(rows).max(initial=0))
    if most * most * max(len(rows), 1) < 1 << 53:
        wide = rows.astype(np.float64)
        return (wide.T @ wide).astype(np.int64).astype(object)
    wide = rows.astype(object)
    return wide.T @ wide


def moments(rows: DataFrame) -> Moments:
    """Exact sums over the rows of :func:`whole`, then the covariance about the mean."""
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("entries")), F.lit(0))).first()
    if not n or not width:
        return Moments(n, [], np.zeros((0, 0)))

    def sums_of(batches: Iterator[pa.RecordBatch]) -> list[int]:
        total = np.zeros(width, object)
        for part in _parts(batches, width):
            total += (part >> 20).sum(axis=0).astype(object) * (1 << 20) + (part & 0xFFFFF).sum(axis=0).astype(object)
        return total.tolist()

    plain = _total(rows, sums_of, [0] * width)
    centre = np.array([(2 * x + n) // (2 * n) for x in plain], np.int64)  # the whole number next to the mean
    rest = np.array([x - n * int(c) for x, c in zip(plain, centre, strict=True)], object)
    upper = np.triu_indices(width)

    def products_of(batches: Iterator[pa.RecordBatch]) -> list[int]:
        total = np.zeros(len(upper[0]), object)
        for part in _parts(batches, width):
            total += exact_products(part - centre)[upper]
        return total.tolist()

    products = np.array(_total(rows, products_of, [0] * len(upper[0])), object)
    exact = n * products - rest[upper[0]] * rest[upper[1]]  # n * n times the covariance
    covariance = np.zeros((width, width))
    covariance[upper] = [x / (n * n) for x in exact]
    covariance = covariance + np.triu(covariance, 1).T
    return Moments(n, [x + n * SHIFT for x in plain], covariance)


def three_diagonals(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The diagonal of a similar matrix with three diagonals, and the squares of the one beside it (Householder)."""
    a = a.astype(np.float64).copy()
    n = len(a)
    beside = np.zeros(max(n - 1, 0))
    for k in range(n - 1):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        beside[k] = norm * norm
        if k == n - 2 or norm == 0:
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x
        q = p - (x @ p) * x
        rest -= 2 * np.outer(x, q) + 2 * np.outer(q, x)
    return np.diag(a).copy(), beside


def below(diagonals: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each shift: the negative pivots of the shifted matrix."""
    main, beside = diagonals
    shifts = np.atleast_1d(np.asarray(shifts, float))
    count = np.zeros(len(shifts), np.int64)
    tiny = np.finfo(float).tiny * 1e20
    pivot = np.ones(len(shifts))
    for k in range(len(main)):
        pivot = main[k] - shifts - (beside[k - 1] / pivot if k else 0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


@dataclass
class Interval:
    low: float
    high: float
    count: int


def intervals(covariance: np.ndarray, components: int, size: int = INTERVAL) -> list[Interval]:
    """Intervals from the top of the spectrum down that hold at least ``components`` eigenvalues, or all above zero.

    Cuts lie in the widest gap that is near, never between eigenvalues that rounding can't tell apart.
    """
    n = len(covariance)
    diagonals = three_diagonals(covariance)
    reach = float(np.abs(covariance).sum(axis=1).max(initial=0))
    if reach == 0:
        return []
    wanted = min(n, components + size + 1)
    low, high = np.full(wanted, -1e-3 * reach), np.full(wanted, reach * (1 + 1e-12))
    rank = np.arange(wanted)  # of the largest eigenvalue, the second, ...
    for _ in range(60):
        middle = (low + high) / 2
        above = n - below(diagonals, middle) > rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    values = (low + high) / 2
    nonzero = int((values > ZERO * values[0]).sum())
    if not nonzero:
        return []
    last = min(components, nonzero)
    # values[i] and values[i + 1] may be cut apart where gap[i] is wide, and what is taken for zero is cut off always.
    gap = np.append(values[:-1] - values[1:], np.inf if wanted == n else 0)
    out, begin, top = [], 0, values[0] + reach * 1e-6
    while begin < last:
        places = [i for i in range(begin, nonzero) if gap[i] > TIE * values[0] or (i + 1 == nonzero and nonzero < wanted)]
        near = [i for i in places if i - begin < size] or places[:1]
        if not near:  # a tie reaches beyond the eigenvalues looked at
            return intervals(covariance, n, size)
        best = max(near, key=lambda i: gap[i] * (1 + i - begin))
        cut = (values[best] + values[best + 1]) / 2 if best + 1 < wanted else values[best] / 2
        out.append(Interval(float(cut), float(top), best + 1 - begin))
        begin, top = best + 1, cut
    counts = below(diagonals, np.array([x.low for x in out])), below(diagonals, np.array([x.high for x in out]))
    for x, low_, high_ in zip(out, *counts, strict=True):
        x.count = int(high_ - low_)
    return out


def contour(a: np.ndarray, interval: Interval, nodes: int = NODES, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues in an interval, largest first, and their vectors as columns."""
    n = len(a)
    centre, radius = (interval.low + interval.high) / 2, (interval.high - interval.low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    turns = np.exp(1j * np.pi / 2 * (1 - points))  # the upper half; the lower gives the conjugate
    width = min(n, 2 * interval.count + 8)
    scale = float(np.abs(a).sum(axis=1).max())
    subspace = np.random.default_rng(seed).normal(size=(n, width))
    eye = np.eye(n)
    solvers = [np.linalg.inv((centre + radius * turn) * eye - a) for turn in turns]
    best, stale = np.inf, 0
    for _ in range(ROUNDS):
        projected = sum(w / 2 * (radius * turn * (solver @ subspace)).real for w, turn, solver in zip(weights, turns, solvers, strict=True))
        basis, _ = np.linalg.qr(projected)
        values, turned = np.linalg.eigh(basis.T @ a @ basis)  # Rayleigh-Ritz
        subspace = basis @ turned
        inside = np.flatnonzero((values > interval.low) & (values < interval.high))
        residual = np.linalg.norm(a @ subspace[:, inside] - subspace[:, inside] * values[inside], axis=0).max(initial=0) / scale
        if len(inside) == interval.count:
            stale = stale + 1 if residual > best / 2 else 0
            best = min(best, residual)
            if residual <= RESIDUAL or (stale >= 3 and residual <= 50 * RESIDUAL):
                order = inside[::-1]
                return values[order], subspace[:, order]
    raise ArithmeticError(f"of {interval.count} eigenvalues in [{interval.low}, {interval.high}] {len(inside)} were found")


def components(spark: SparkSession, covariance: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues above zero and their unit vectors as rows; every interval is solved in a task."""
    parts = intervals(covariance, most)
    if not parts:
        return np.zeros(0), np.zeros((0, len(covariance)))
    sent = spark.sparkContext.broadcast(covariance)  # a number per pair of dimensions, whatever the rows

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, vectors = contour(sent.value, Interval(row["low"], row["high"], row["count"]))
                columns = [pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, ["value", "vector"])

    rows = spark.createDataFrame([(x.low, x.high, x.count) for x in parts], "low double, high double, count long")
    found = rows.repartition(len(parts)).mapInArrow(solve, "value double, vector array<double>").toArrow().to_pylist()
    found = sorted(found, key=lambda r: -r["value"])
    if len(found) != sum(x.count for x in parts):
        raise ArithmeticError("eigenvalues found and counted differ")
    # Vectors of different intervals are orthogonal but for rounding; what is left of it is taken out, largest values first.
    vectors = np.linalg.qr(np.array([r["vector"] for r in found[:most]]).T)[0].T
    largest = np.abs(vectors).argmax(axis=1)
    vectors *= np.sign(vectors[np.arange(len(vectors)), largest])[:, None]
    return np.array([r["value"] for r in found[:most]]), vectors


@dataclass
class Transform:
    """What it takes to whiten a row."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    def centred(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n times each entry less its sum, exactly, and its sum of squares in 64 bits."""
        sums = np.array([x - self.n * SHIFT for x in self.sums], object)
        reach = (self.n * int(np.abs(rows).max(initial=0)) + max(abs(x) for x in sums)) if len(rows) else 0
        if reach * reach * max(len(sums), 1) < 1 << 63:
            apart = self.n * rows - sums.astype(np.int64)
            return apart.astype(np.float64), (apart * apart).sum(axis=1)
        apart = self.n * rows.astype(object) - sums
        squares = [min(x, (1 << 63) - 1) for x in (apart * apart).sum(axis=1)]
        return (apart / self.n * self.n).astype(np.float64), np.array(squares, np.int64)

    def whitened(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        apart, deviation = self.centred(rows)
        return (apart / self.n) @ self.vectors.T / np.sqrt(self.values), deviation


def identity_error(rows: DataFrame, sent, size: int, width: int) -> float:
    """How far the covariance of the whitened rows is from the identity, at most; the rows are whitened and summed."""

    def of(batches: Iterator[pa.RecordBatch]) -> list[float]:
        first, second = np.zeros(size), np.zeros((size, size))
        for part in _parts(batches, width):
            white, _ = sent.value.whitened(part)
            first += white.sum(axis=0)
            second += white.T @ white
        return [*first.tolist(), *second.ravel().tolist()]

    total = np.array(_total(rows, of, [0.0] * (size + size * size)))
    mean = total[:size] / sent.value.n
    covariance = total[size:].reshape(size, size) / sent.value.n - np.outer(mean, mean)  # the mean is zero but for rounding
    return float(np.abs(covariance - np.eye(size)).max())


def whitened(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every row and component."""
    spark = vectors.sparkSession
    rows = stored(whole(vectors), "whole-vectors")
    found = moments(rows)
    values, axes = components(spark, found.covariance, most)
    kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not len(values):
        return spark.createDataFrame([], kinds)
    size, width = len(values), len(found.covariance)
    sent = spark.sparkContext.broadcast(Transform(found.n, found.sums, values, axes))
    error = identity_error(rows, sent, size, width)
    explained = values / np.trace(found.covariance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                white, deviation = sent.value.whitened(matrix(part.column("entries"), width))
                each = np.repeat(np.arange(len(white)), size)
                columns = [
                    part.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(white))),
                    pa.array(np.full(len(each), sent.value.n)),
                    pa.array(deviation[each]),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, len(white))),
                    pa.array(np.full(len(each), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in kinds.split(", ")])

    return rows.mapInArrow(run, kinds)
