"""Whitening of embeddings by the leading eigenvectors of their covariance, found by contour integration.

Spark adds up counts, sums and products of the vectors, as integers, so the covariance does not depend on how the
rows are dealt out. Its eigenvalues are cut into intervals by inertia counts: the signs of the pivots of a shifted,
factored matrix tell how many eigenvalues lie above the shift. For each interval a quadrature of complex
shifted solves around it projects a block of vectors onto its eigenvectors (FEAST), a Rayleigh-Ritz step extracts them, and
both are repeated until the residuals vanish. The inertia counts then verify that none is missed.

The driver holds matrices of dimension by dimension, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import added_arrays, rows

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000  # of the integers that entries become
ENTRY_LIMIT = 2.0**61  # of a scaled entry: beyond, differences would leave 64 bits
NODES = 8  # of the quadrature on half the contour
SLICE = 16  # eigenvalues of an interval, more only if they are equal
MOST_ROUNDS = 50
LOW_BITS = 26  # sums are kept in two parts, so that they do not overflow
EXACT = 2**53  # below this, doubles hold integers exactly
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def integers(vectors: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors of ``size`` entries, and their entries as integers, a row each."""
    length = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    entries = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) * SCALE  # a null is not a number
    own = np.repeat(np.arange(len(length)), np.maximum(length, 0))
    wrong = np.bincount(own[~(np.abs(entries) < ENTRY_LIMIT)], minlength=len(length))
    usable = (length == size) & (wrong == 0)
    whole = np.floor(entries[usable[own]]).astype(np.int64) + OFFSET
    return np.flatnonzero(usable), whole.reshape(-1, size)


def most_common_size(table: DataFrame, column: str) -> int:
    """The number of entries that most vectors have, the larger one of a tie; 0 without vectors."""
    sizes = table.where(F.col(column).isNotNull()).groupBy(F.size(column).alias("size")).count()
    found = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return found["size"] if found else 0


@dataclass(frozen=True)
class Moments:
    """Count, and per entry the sum, a whole number near the mean, and the greatest distance from it."""

    n: int
    total: list[int]
    centre: np.ndarray
    reach: int

    @property
    def rest(self) -> list[int]:
        """Sums of what the centre leaves of the entries."""
        return [t - self.n * int(c) for t, c in zip(self.total, self.centre)]


def moments(table: DataFrame, column: str, size: int) -> Moments:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        most, least = np.full(size, np.iinfo(np.int64).min), np.full(size, np.iinfo(np.int64).max)
        for batch in batches:
            _, x = integers(batch.column(0), size)
            if len(x):
                n += len(x)
                high += (x >> LOW_BITS).sum(0)
                low += (x & ((1 << LOW_BITS) - 1)).sum(0)
                most, least = np.maximum(most, x.max(0)), np.minimum(least, x.min(0))
        if n:
            yield rows(j=np.arange(size), n=np.full(size, n), high=high, low=low, most=most, least=least)

    sums = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    made = table.select(column).mapInArrow(run, "j long, n long, high long, low long, most long, least long")
    found = made.groupBy("j").agg(*sums, F.max("most").alias("most"), F.min("least").alias("least")).orderBy("j").collect()
    if not found:
        return Moments(0, [], np.empty(0, np.int64), 0)
    n, total = int(found[0].n), [(int(r.high) << LOW_BITS) + int(r.low) for r in found]
    centre = [t // n for t in total]
    reach = max(max(r.most - c, c - r.least) for r, c in zip(found, centre))
    return Moments(n, total, np.array(centre, np.int64), int(reach))


def scatter(table: DataFrame, column: str, size: int, m: Moments) -> np.ndarray:
    """Sums of products of entries, centred. Rows of the matrix are summed by tasks, each from what the tasks before found.

    Integers while they fit, as Python's own; else doubles.
    """
    exact = m.reach**2 * 1024 < EXACT and m.reach**2 * m.n < 2**62
    step = max(1024, EXACT // max(1, m.reach**2)) if exact else 65_536
    kind = np.int64 if exact else np.float64
    offset = np.zeros(size) if exact else np.array([r / m.n for r in m.rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = np.zeros((size, size), kind)
        for batch in batches:
            _, x = integers(batch.column(0), size)
            for at in range(0, len(x), step):
                y = (x[at : at + step] - m.centre).astype(np.float64) - offset
                made += (y.T @ y).astype(kind)
        yield rows(i=np.arange(size), products=pa.array([r.tobytes() for r in made], pa.binary()))

    found = added_arrays(table.select(column).mapInArrow(run, "i long, products binary"), kind).toArrow()
    made = np.zeros((size, size), kind)
    for i, products in zip(found.column("i").to_pylist(), found.column("products").to_pylist()):
        made[i] = np.frombuffer(products, kind)
    return made


def covariance(products: np.ndarray, m: Moments) -> np.ndarray:
    """With divisor n. From integers every entry is the double nearest to its exact value."""
    if products.dtype == np.float64:
        return (products + products.T) / (2 * m.n)
    rest, square = m.rest, m.n * m.n
    whole = products.tolist()
    return np.array([[(m.n * p - a * b) / square for p, b in zip(line, rest)] for line, a in zip(whole, rest)])


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues above ``shift``: positive pivots of the shifted matrix, factored with pivots of one or two rows (Bunch and Parlett)."""
    left = matrix - shift * np.eye(len(matrix))
    above, tie = 0, (1 + 17**0.5) / 8
    while len(left):
        diagonal = np.abs(np.diag(left))
        off = np.abs(left)
        np.fill_diagonal(off, 0)
        p, (r, s) = int(diagonal.argmax()), np.unravel_index(off.argmax(), off.shape)
        if diagonal[p] == 0 and off[r, s] == 0:
            break
        if diagonal[p] >= tie * off[r, s]:
            above += int(left[p, p] > 0)
            pivot, rest = [p], np.delete(np.arange(len(left)), p)
        else:
            above += 1  # one of the two is positive, one negative
            pivot, rest = [r, s], np.delete(np.arange(len(left)), [r, s])
        cross = left[np.ix_(rest, pivot)]
        left = left[np.ix_(rest, rest)] - cross @ np.linalg.solve(left[np.ix_(pivot, pivot)], cross.T)
        left = (left + left.T) / 2
    return above


def boundary(matrix: np.ndarray, k: int, bound: float) -> float:
    """The greatest shift, to double precision, above which at least ``k`` eigenvalues lie."""
    low, high = -bound, bound
    for _ in range(60):
        middle = (low + high) / 2
        if not low < middle < high or high - low <= 4 * np.finfo(float).eps * bound:
            break
        low, high = (middle, high) if count_above(matrix, middle) >= k else (low, middle)
    return low


def intervals(matrix: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues) from the top, which together hold the ``k`` greatest.

    They end midway between eigenvalues, equal ones stay together, and none spans more than a factor of about four: on the
    scale of a wider one, small eigenvalues would lie too close together for the contour to part them.
    """
    bound = 1.01 * float(np.abs(matrix).sum(1).max()) + np.finfo(float).tiny
    margin = 100 * np.finfo(float).eps * bound
    above, high = 0, 2 * bound
    found = []
    while above < k:
        top = boundary(matrix, above + 1, bound)
        high = min(high, top + abs(top) / 8 + margin)
        wanted = min(k, above + SLICE)
        if top > margin:
            wanted = min(wanted, max(above + 1, count_above(matrix, top / 4)))
        at = boundary(matrix, wanted, bound) - margin
        while (count := count_above(matrix, at)) < len(matrix):
            below = boundary(matrix, count + 1, bound)
            if at - below > margin:
                break
            at = below - margin
        low = at - max(abs(at), margin) if count == len(matrix) else (at + below) / 2
        found.append((low, high, count - above))
        above, high = count, low
    return found


def contour_pairs(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between low and high, rising, and their unit eigenvectors as columns."""
    size = len(matrix)
    width = min(size, count + max(8, count // 2))
    points, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi / 2 * (points + 1))
    centre, radius = (low + high) / 2, (high - low) / 2
    inverse = [np.linalg.inv((centre + radius * t) * np.eye(size) - matrix) for t in turn]
    scale = float(np.abs(matrix).max()) * size
    block, best = np.random.default_rng(20_240_101).standard_normal((size, width)), np.inf
    for _ in range(MOST_ROUNDS):
        projected = sum(w / 2 * (radius * t * (solve @ block)).real for w, t, solve in zip(weights, turn, inverse))
        basis, _ = np.linalg.qr(projected)
        values, turned = np.linalg.eigh(basis.T @ matrix @ basis)  # Rayleigh-Ritz
        block = basis @ turned
        inside = (values > low) & (values < high)
        residual = np.abs(matrix @ block[:, inside] - block[:, inside] * values[inside]).max(initial=0.0)
        if inside.sum() == count and (residual <= 4 * np.finfo(float).eps * scale and residual >= best / 2):
            break  # as small as it gets
        best = min(best, residual) if inside.sum() == count else np.inf
    if inside.sum() != count:
        raise ArithmeticError(f"{int(inside.sum())} eigenvalues between {low} and {high}, where inertia counts {count}")
    return values[inside], block[:, inside]


def leading_pairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues, falling, and their eigenvectors; without those that are zero but for rounding."""
    trace = float(np.trace(matrix))
    if not trace > 0:
        return np.empty(0), np.empty((len(matrix), 0))
    scaled = matrix / trace
    found = [contour_pairs(scaled, *interval) for interval in intervals(scaled, min(k, len(matrix)))]
    values, vectors = np.concatenate([v for v, _ in found]), np.concatenate([x for _, x in found], 1)
    order = np.argsort(-values, kind="stable")[:k]
    order = order[values[order] > len(matrix) * np.finfo(float).eps]
    values, vectors = values[order], vectors[:, order]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(order))]) if len(order) else 1.0
    return values * trace, vectors * sign


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: moments of the fit list, eigenvalues and eigenvectors of its covariance, and its trace."""

    size: int
    moments: Moments
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n as doubles, and so exact to a rounding."""
        m = self.moments
        y = x - m.centre
        if m.n * (m.reach + 1) < EXACT:
            return (y * m.n - np.array(m.rest, np.int64)) / m.n
        return y - np.array([r / m.n for r in m.rest])

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sums of (n * x - S) squared; null beyond 64 bits."""
        m = self.moments
        y = x - m.centre
        if (m.n * (m.reach + 1)) ** 2 * self.size < 2**63:
            return pa.array(((y * m.n - np.array(m.rest, np.int64)) ** 2).sum(1), pa.int64())
        rest = m.rest
        sums = [sum((m.n * a - b) ** 2 for a, b in zip(line, rest)) for line in y.tolist()]
        return pa.array([s if s < 2**63 else None for s in sums], pa.int64())


def fit(table: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Learn from all usable vectors: those without nulls and infinite entries, as long as most vectors are."""
    size = most_common_size(table, column)
    m = moments(table, column, size) if size else Moments(0, [], np.empty(0, np.int64), 0)
    if not m.n:
        return Whitening(size, m, np.empty(0), np.empty((size, 0)), 0.0)
    matrix = covariance(scatter(table, column, size, m), m)
    return Whitening(size, m, *leading_pairs(matrix, components), float(np.trace(matrix)))


def identity_error(table: DataFrame, white: Whitening, column: str = "embedding") -> float:
    """How far the covariance of the whitened vectors is from the identity, at most over its entries."""
    k = len(white.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = np.zeros((k, k))
        for batch in batches:
            w = white.project(integers(batch.column(0), white.size)[1])
            made += w.T @ w
        yield rows(at=np.arange(k * k), product=made.ravel())

    found = table.select(column).mapInArrow(run, "at long, product double").groupBy("at").agg(F.sum("product").alias("product"))
    made = np.zeros(k * k)
    for r in found.collect():  # k * k rows
        made[r["at"]] = r["product"]
    return float(np.abs(made.reshape(k, k) / white.moments.n - np.eye(k)).max(initial=0.0))


def whitened(table: DataFrame, white: Whitening, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, deviation, whitened), the last an array of a value per component, of the usable rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = integers(batch.column(1), white.size)
            values = white.project(x)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), len(white.values))
            yield rows(
                vec_id=batch.column(0).take(pa.array(at)).cast(pa.int64()),
                deviation=white.deviation(x),
                whitened=lists.cast(pa.list_(pa.float64())),
            )

    return table.select(key, column).mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per usable row of ``table`` (vec_id, embedding) and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    A row is dropped if its vector is null, holds a null, a NaN, an infinite entry or one whose integer leaves 64 bits, or has another
    length than most vectors. Components of no variance are left out, so equal vectors give no rows, and an empty table none. A
    deviation beyond 64 bits is null. Repeated rows count each time, null ids keep their rows, other columns play no part.
    """
    white = fit(table, components=components)
    if not len(white.values):
        return table.sparkSession.createDataFrame([], SCHEMA)
    error = identity_error(table, white)
    explained = F.array(*(F.lit(float(v) / white.trace) for v in white.values))
    each = whitened(table, white).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(white.moments.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, "at").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
