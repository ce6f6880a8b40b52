"""Embedding whitening by spectrum slicing of an exactly summed covariance.

*Covariance.*  Vectors of whole numbers are summed exactly.  One pass gives the number n of rows and the sums S of each
dimension; a second sums products of entries centred at the whole number nearest the mean.  Blocks of rows are
multiplied as floating-point numbers small enough to be exact, larger entries in limbs of 20 bits, and tasks
send one number per pair of dimensions, which Spark adds as decimals.  The rest of the centring is done in whole
numbers too, so that V is the covariance (divisor n) rounded once.

*Spectrum slicing.*  The signs of the pivots of an LDLᵀ factorisation of V - s*I (symmetric pivoting with blocks of
one and two, after Bunch and Kaufman) count the eigenvalues below and above s.  Bisection by these counts isolates each
leading eigenvalue in an interval of its own.  From its middle, an inverse iteration and then Rayleigh quotient
iteration, which converges cubically, give the eigenpair, kept orthogonal to the ones before.
Counts just below and above the eigenvalue certify its number; an iteration that ends
outside its interval is begun again from a smaller interval.  Eigenvalues that no count can tell apart at
double precision are one cluster, of which any orthonormal basis consists of eigenvectors.

*Whitening.*  ``(x - S / n)`` projected on each component over the root of its eigenvalue.  The covariance of all whitened rows
is summed in a further pass, and its largest distance from the identity is returned with each row.

Everything collected has a size given by the dimension (at most d * d numbers), never by the rows; no row is shuffled.

Defined results: rows whose vector is null, empty, or holds null or non-finite entries are dropped, as are vectors
of another length than the most frequent one (of equally frequent ones the longest); a null vec_id stays; repeated
rows count each and get equal results; entries beyond 2^58 are cut to it; a deviation beyond the range of a long is null;
components of eigenvalue 0 (as for equal rows, or fewer rows than dimensions) do not exist, so that one row or equal
rows give no rows, as does an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
GRID, ORIGIN = 64, 1_000_000
_LIMB = 20
_LARGEST = 1 << 58
_ROWS = 4096


def grid(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x): vectors without null or non-finite entries, each entry c as the whole number floor(64 * c) + 1000000."""
    c = F.col(column)
    usable = vectors.where(c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < float("inf"))))

    def whole(e):
        return F.floor(F.least(F.greatest(e.cast("double") * GRID, F.lit(-float(_LARGEST))), F.lit(float(_LARGEST)))) + ORIGIN

    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(c, whole).alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(vec_ids, (rows, d) whole numbers), at most _ROWS rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            piece = batch.slice(at, _ROWS)
            yield piece.column("vec_id"), piece.column("x").flatten().to_numpy().reshape(-1, d)


def _limbs(z: np.ndarray) -> list[np.ndarray]:
    """Floating-point matrices whose sum, each times 2^20 more than the one before, is z; entries below 2^20."""
    out, sign, z = [], np.sign(z), np.abs(z)
    while not out or z.any():
        out.append((sign * (z & ((1 << _LIMB) - 1))).astype(float))
        z = z >> _LIMB
    return out


class _Gram:
    """Exact sums of products of columns, as Python's whole numbers."""

    def __init__(self, d: int):
        self.total = np.zeros((d, d), object)

    def add(self, z: np.ndarray) -> None:
        limbs = _limbs(z)
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                # 4096 products below 2^40: every partial sum is below 2^53 and so exact
                self.total += (a.T @ b).astype(np.int64).astype(object) * (1 << _LIMB * (i + j))


def _sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """n, and the sums of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for _, x in _matrices(batches, d):
            n, high, low = n + len(x), high + (x >> 30).sum(0), low + (x & ((1 << 30) - 1)).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array(np.full(d, n)), pa.array(high), pa.array(low)],
                                             ["i", "n", "high", "low"])

    sums = (rows.select(F.lit(None).cast("long").alias("vec_id"), "x").mapInArrow(add, "i int, n long, high long, low long")
            .groupBy("i").agg(F.sum("n").alias("n"), *(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")))
            .orderBy("i").collect())
    return sums[0]["n"], [(int(r["high"]) << 30) + int(r["low"]) for r in sums]


def covariance(rows: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums S, and the covariance matrix of ``rows`` (x, all of length d), rounded once."""
    n, sums = _sums(rows, d)
    middle = [(2 * s + n) // (2 * n) for s in sums]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, some = _Gram(d), False
        for _, x in _matrices(batches, d):
            gram.add(x - np.array(middle, np.int64))
            some = True
        if some:
            i, j = np.triu_indices(d)
            # decimals hold 38 digits, so each sum travels in two parts
            high, low = gram.total[i, j] >> 60, gram.total[i, j] & ((1 << 60) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([int(v) for v in high], pa.decimal128(38)),
                                              pa.array([int(v) for v in low], pa.int64())], ["i", "j", "high", "low"])

    summed = (rows.select(F.lit(None).cast("long").alias("vec_id"), "x").mapInArrow(products, "i int, j int, high decimal(38,0), low long")
              .groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect())
    rest = [s - n * m for s, m in zip(sums, middle)]
    out = np.zeros((d, d))
    for r in summed:
        i, j = r["i"], r["j"]
        exact = n * ((int(r["high"]) << 60) + int(r["low"])) - rest[i] * rest[j]
        out[i, j] = out[j, i] = float(Fraction(exact, n * n))
    return n, sums, out


def count_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric v lie above ``shift``: the positive pivots of L*D*Lᵀ = v - shift * I."""
    a = v - shift * np.eye(len(v))
    least = np.finfo(float).eps * max(np.abs(v).max(initial=0.0), abs(shift), np.finfo(float).tiny)
    alpha = (1 + 17 ** 0.5) / 8
    above = k = 0
    m = len(a)
    while k < m:
        column = np.abs(a[k + 1:, k])
        r = k + 1 + int(column.argmax()) if len(column) else k
        lead = column.max(initial=0.0)
        pivot, two = k, False
        if lead > 0 and abs(a[k, k]) < alpha * lead:
            row = np.abs(a[r, k:])
            row[r - k] = 0.0
            if abs(a[k, k]) * row.max() >= alpha * lead * lead:
                pivot = k
            elif abs(a[r, r]) >= alpha * row.max():
                pivot = r
            else:
                two = True
        to, start = (r, k + 1) if two else (pivot, k)
        if to != start:
            a[[to, start]] = a[[start, to]]
            a[:, [to, start]] = a[:, [start, to]]
        if two:
            block, side = a[k: k + 2, k: k + 2], a[k + 2:, k: k + 2]
            # a block of two is taken only where its determinant is negative: one pivot of each sign
            above += 1
            a[k + 2:, k + 2:] -= side @ np.linalg.solve(block, side.T)
            k += 2
        else:
            d = a[k, k] if abs(a[k, k]) > least else -least
            above += d > 0
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k + 1:, k] / d)
            k += 1
    return int(above)


def _orthogonal(x: np.ndarray, against: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for u in against:
            x = x - (u @ x) * u
    return x / np.linalg.norm(x)


def _solve(v: np.ndarray, shift: float, x: np.ndarray, scale: float) -> np.ndarray:
    try:
        return np.linalg.solve(v - shift * np.eye(len(v)), x)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
        return np.linalg.solve(v - (shift + 2 * np.finfo(float).eps * scale) * np.eye(len(v)), x)


def _refined(v: np.ndarray, low: float, high: float, found: list[np.ndarray], turn: np.random.Generator, scale: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from the middle of an interval."""
    x = _orthogonal(turn.standard_normal(len(v)), found)
    for _ in range(2):
        x = _orthogonal(_solve(v, (low + high) / 2, x, scale), found)
    best = (np.inf, 0.0, x)
    for _ in range(12):
        value = float(x @ v @ x)
        error = float(np.linalg.norm(v @ x - value * x))
        if error >= best[0] / 2:
            break
        best = (error, value, x)
        if error <= np.finfo(float).eps * scale:
            break
        x = _orthogonal(_solve(v, value, x, scale), found)
    return best[1], best[2]


def eigenpairs(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` leading (eigenvalues, unit eigenvectors as columns) that are not 0 at double precision, in falling order."""
    d = len(v)
    # Gershgorin: no eigenvalue lies beyond
    scale = float(np.abs(v).sum(1).max(initial=0.0))
    if not scale:
        return np.zeros(0), np.zeros((d, 0))
    tiny = 8 * d * np.finfo(float).eps * scale
    counts: dict[float, int] = {}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = count_above(v, shift)
        return counts[shift]

    wanted = min(most, above(tiny))
    values, vectors, turn = [], [], np.random.Generator(np.random.PCG64(d))
    open_ = [(tiny, 2 * scale)]
    while len(values) < wanted:
        low, high = open_.pop()
        first, last = above(high) + 1, above(low)
        middle = (low + high) / 2
        if first > last or first > wanted:
            continue
        narrow = high - low <= tiny / 4 or not low < middle < high
        if first < last and not narrow:
            open_ += [(low, middle), (middle, high)]
            continue
        # one eigenvalue, or a cluster that counts cannot tell apart
        for number in range(first, min(last, wanted) + 1):
            value, vector = _refined(v, low, high, vectors, turn, scale)
            sure = narrow or (low < value <= high and above(value + tiny) < number <= above(value - tiny))
            if not sure:
                open_ += [(low, middle), (middle, high)]
                break
            values.append(value)
            vectors.append(vector)
    return np.array(values), np.array(vectors).reshape(-1, d).T


def _identity_error(rows: DataFrame, n: int, project) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for whitened in project(batches):
            y = np.concatenate((whitened, np.ones((len(whitened), 1))), 1)
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    summed = (rows.select(F.lit(None).cast("long").alias("vec_id"), "x").mapInArrow(gram, "i int, j int, v double")
              .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    k = max(r["i"] for r in summed)
    total = np.zeros((k + 1, k + 1))
    for r in summed:
        total[r["i"], r["j"]] = r["v"] / n
    # rows are centred already; what rounding left of their means is taken off
    return float(np.abs(total[:k, :k] - np.outer(total[:k, k], total[:k, k]) - np.eye(k)).max())


def _deviations(centred: np.ndarray, x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sums over dimensions of (n * x - S)^2, exact; null beyond a long."""
    if sums.dtype != object and float((centred.astype(float) ** 2).sum(1).max(initial=0.0)) * n * n < 2.0 ** 62:
        y = n * x - sums
        return pa.array((y * y).sum(1).astype(np.int64))
    totals = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
    return pa.array([t if t < 1 << 63 else None for t in totals], pa.int64())


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of ``rows`` (vec_id, x) for each component."""
    spark = rows.sparkSession
    shape = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = rows.groupBy(F.size("x").alias("d")).count().where("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], shape)
    d = lengths["d"]
    rows = rows.where(F.size("x") == d)
    n, sums, v = covariance(rows, d)
    values, vectors = eigenpairs(v, components)
    k = len(values)
    if not k:
        return spark.createDataFrame([], shape)
    explained = values / np.trace(v)
    basis = vectors / np.sqrt(values)
    exact = any(abs(s) >= 1 << 62 for s in sums)
    s_row = np.array(sums, object if exact else np.int64)
    whole, part = np.array([s // n for s in sums], np.int64), np.array([float(Fraction(s % n, n)) for s in sums])

    def projected(x: np.ndarray) -> np.ndarray:
        return ((x - whole) - part) @ basis

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, x in _matrices(batches, d):
            yield projected(x)

    error = _identity_error(rows, n, project)

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _matrices(batches, d):
            m = len(x)
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                _deviations(x - whole, x, n, s_row).take(each), pa.array(projected(x).ravel()), pa.array(np.tile(explained, m)),
                pa.array(np.full(m * k, error)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(results, shape)
