"""Whitening of vectors: leading eigenpairs of an exactly summed covariance by spectrum slicing."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityspark.llm.common import arrow_batches
from entityspark.storage import materialize

EPS = float(np.finfo(np.float64).eps)
#: Entries are bounded by this after scaling, so that integers stay integers.
LARGEST = float(1 << 52)


def positive_eigenvalues(a: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are above zero: by Sylvester's law as many as the block-diagonal D of
    its factors P a P' = L D L' has. Pivots of one or two rows are chosen as Bunch and Kaufman do."""
    a, n, k, found = a.copy(), len(a), 0, 0
    bound = (1 + 17 ** 0.5) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1:, k])
        most = below.max(initial=0.0)
        single = True
        if abs(a[k, k]) < bound * most:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[k:, r])
            row[r - k] = 0.0
            across = row.max()
            if abs(a[k, k]) * across < bound * most * most:
                single = abs(a[r, r]) >= bound * across
                swap(k if single else k + 1, r)
        if single:
            pivot = a[k, k]
            found += bool(pivot > 0)
            if pivot != 0:
                a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k + 1:, k] / pivot)
            k += 1
        else:  # a pivot of two rows has a negative determinant: one eigenvalue of either sign
            found += 1
            c = a[k + 2:, k:k + 2].copy()
            a[k + 2:, k + 2:] -= c @ np.linalg.solve(a[k:k + 2, k:k + 2], c.T)
            k += 2
    return found


class Spectrum:
    """Leading eigenpairs of a symmetric positive semidefinite matrix, numbered by inertia counts."""

    def __init__(self, v: np.ndarray):
        self.v, self.eye = v, np.eye(len(v))
        self.scale = float(np.abs(v).sum(1).max(initial=0.0))
        self.slack = 4 * len(v) * EPS * self.scale
        self.counts: dict[float, int] = {}

    def above(self, shift: float) -> int:
        """Eigenvalues above a shift."""
        if shift not in self.counts:
            self.counts[shift] = positive_eigenvalues(self.v - shift * self.eye)
        return self.counts[shift]

    def bracket(self, j: int) -> tuple[float, float]:
        """The tightest shifts known so far with the j-th eigenvalue between them."""
        low = max((s for s, c in self.counts.items() if c >= j), default=0.0)
        return low, min((s for s, c in self.counts.items() if c < j), default=2 * self.scale)

    def solve(self, shift: float, b: np.ndarray) -> np.ndarray:
        while True:
            try:
                y = np.linalg.solve(self.v - shift * self.eye, b)
                if np.isfinite(y).all():
                    return y
            except np.linalg.LinAlgError:
                pass
            shift += self.slack or EPS

    def rayleigh(self, start: np.ndarray, shift: float) -> tuple[float, np.ndarray, float]:
        """Value, unit vector and residual where Rayleigh quotient iteration settles; it converges cubically."""
        x = self.solve(shift, start)
        x /= np.linalg.norm(x)
        best = None
        for _ in range(30):
            value = float(x @ self.v @ x)
            left = float(np.linalg.norm(self.v @ x - value * x))
            if best is not None and left >= best[2] / 2 and best[2] <= self.slack:
                break
            if best is None or left < best[2]:
                best = value, x, left
            x = self.solve(value, x)
            x /= np.linalg.norm(x)
        return best

    def leading(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Up to `most` eigenvalues in falling order and their vectors as rows, without those that rounding cannot
        tell from zero."""
        d, random = len(self.v), np.random.default_rng(7)
        most = min(most, self.above(self.slack)) if self.scale > 0 else 0
        values, vectors = [], np.zeros((0, d))
        while len(values) < most:
            j = len(values) + 1
            low, high = self.bracket(j)
            together = self.above(low) - self.above(high)
            if together > 1 and high - low > 2 * self.slack:
                self.above((low + high) / 2)
                continue
            if together == 1:
                start = random.standard_normal(d)
                value, x, left = self.rayleigh(start - vectors.T @ (vectors @ start), (low + high) / 2)
                margin = max(4 * left, self.slack)
                # counts on either side certify that it is the j-th and no other
                if left <= self.slack and low < value < high and self.above(value - margin) >= j > self.above(value + margin):
                    if self.above(value - margin) == j:
                        values.append(value)
                        vectors = np.vstack([vectors, self._apart(x, vectors)])
                        continue
                elif high - low > 2 * self.slack:
                    self.above((low + high) / 2)
                    continue
            for value, x in self._cluster(low, high, max(1, together), vectors):
                values.append(value)
                vectors = np.vstack([vectors, x])
        return np.asarray(values[:most]), vectors[:most]

    def _apart(self, x: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        x = x - vectors.T @ (vectors @ x)
        return x / np.linalg.norm(x)

    def _cluster(self, low: float, high: float, m: int, vectors: np.ndarray) -> list[tuple[float, np.ndarray]]:
        """Eigenvalues nearer to each other than rounding tells: an orthonormal basis of their common space by inverse
        iteration; any basis of it is right."""
        basis = np.random.default_rng(11).standard_normal((len(self.v), m))
        for _ in range(6):
            basis = self.solve((low + high) / 2, basis)
            basis /= np.linalg.norm(basis, axis=0)
            basis -= vectors.T @ (vectors @ basis)
            basis, _ = np.linalg.qr(basis)
        return sorted(((float(b @ self.v @ b), b) for b in basis.T), key=lambda t: -t[0])


def _rows(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def _integer_sums(x: np.ndarray) -> list[int]:
    wide = int(np.abs(x).max(initial=0)) * max(1, len(x)) >= 1 << 62
    return [int(v) for v in (x.astype(object) if wide else x).sum(0)]


def _integer_products(y: np.ndarray) -> np.ndarray:
    """y'y as Python integers, exact: in double precision where all sums stay below 2^53, so they are exact there."""
    d = y.shape[1]
    total = np.zeros((d, d), object)
    wide = np.abs(y).max(1, initial=0) >= 1 << 20
    small = y[~wide].astype(np.float64)
    for at in range(0, len(small), 4096):
        block = small[at:at + 4096]
        total = total + (block.T @ block).astype(np.int64).astype(object)
    for row in y[wide].astype(object):
        total = total + np.outer(row, row)
    return total


def _summed(fit: DataFrame, partial, kind: str) -> dict[tuple[int, int], object]:
    """Sums by (i, j) over the partial sums that each task yields; their number follows the length of a vector only."""
    parts = fit.select("x").mapInArrow(partial, f"i int, j int, v {kind}")
    return {(r.i, r.j): r.v for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}


def _covariance(fit: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """n, sums and covariance (divisor n) of integer vectors. Rows are centred by the nearest integers to their means,
    products are summed as integers and what the rounding of the means left is taken off as integers; each entry is
    then rounded once."""
    def sums(batches):
        n, s = 0, [0] * d
        for batch in batches:
            x = _rows(batch.column("x"))
            n, s = n + len(x), [a + b for a, b in zip(s, _integer_sums(x))]
        yield pa.RecordBatch.from_arrays([pa.array([*range(-1, d)], pa.int32()), pa.array([0] * (d + 1), pa.int32()), pa.array([Decimal(v) for v in (n, *s)], pa.decimal128(38, 0))], ["i", "j", "v"])

    total = {i: int(v) for (i, _), v in _summed(fit, sums, "decimal(38,0)").items()}
    n, s = total[-1], [total[i] for i in range(d)]
    centre = [(2 * v + n) // (2 * n) for v in s]
    at = np.asarray(centre, np.int64)

    def products(batches):
        total = np.zeros((d, d), object)
        for batch in batches:
            total = total + _integer_products(_rows(batch.column("x")) - at)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(v)) for v in total[i, j]], pa.decimal128(38, 0))], ["i", "j", "v"])

    found = _summed(fit, products, "decimal(38,0)")
    left = [v - n * c for v, c in zip(s, centre)]
    v = np.zeros((d, d))
    for (i, j), p in found.items():
        v[i, j] = v[j, i] = (n * int(p) - left[i] * left[j]) / (n * n)
    return n, s, v


class Whitening:
    """A fitted projection: centre, rows (unit eigenvectors over the roots of their eigenvalues) and shares."""

    def __init__(self, n: int, sums: list[int], v: np.ndarray, most: int):
        self.n, self.sums = n, sums
        self.values, self.vectors = Spectrum(v).leading(most)
        self.explained = self.values / max(float(np.trace(v)), np.finfo(np.float64).tiny)
        self.centre = np.asarray([(2 * s + n) // (2 * n) for s in sums], np.int64)
        self.left = [s - n * int(c) for s, c in zip(sums, self.centre)]
        self.rows = self.vectors / np.sqrt(self.values)[:, None]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        centred = (x - self.centre) - np.asarray(self.left, np.float64) / self.n
        return centred @ self.rows.T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - sums)^2, exact; null beyond the range of a long."""
        y = x - self.centre
        bound = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.left))
        if bound * bound * x.shape[1] < 1 << 62:
            z = self.n * y - np.asarray(self.left, np.int64)
            return (z * z).sum(1).tolist()
        z = self.n * y.astype(object) - np.asarray(self.left, object)
        return [int(v) if v < 1 << 63 else None for v in (z * z).sum(1)]


def _identity_error(fit: DataFrame, w: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(w.values)

    def products(batches):
        g = np.zeros((k + 1, k))
        for batch in batches:
            z = w.whitened(_rows(batch.column("x")))
            g[:k] += z.T @ z
            g[k] += z.sum(0)
        i, j = np.indices(g.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(g.ravel())], ["i", "j", "v"])

    g = np.zeros((k + 1, k))
    for (i, j), v in _summed(fit, products, "double").items():
        g[i, j] = v
    mean = g[k] / w.n
    return float(np.abs(g[:k] / w.n - np.outer(mean, mean) - np.eye(k)).max())


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, x: finite vectors as longs, floor(64 c) + 1000000."""
    d = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("e"))
    finite = F.forall("e", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    scaled = lambda c: F.greatest(F.least(c.cast("double") * 64, F.lit(LARGEST)), F.lit(-LARGEST))
    return d.where(finite & (F.size("e") > 0)).select("vec_id", F.transform("e", lambda c: F.floor(scaled(c)) + 1000000).alias("x"))


def whiten_vectors(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every usable row and component.

    The fit list is each distinct integer vector once. Its covariance is summed in the tasks as integers and only this
    matrix, whose size follows the length of a vector and not the rows, comes to the driver. There, inertia counts
    of L D L' factors of shifted covariances slice the spectrum until one eigenvalue is alone, Rayleigh quotient
    iteration finds it, and counts on both sides of the result certify its number.

    Rows whose vector is null, empty or holds null or non-finite entries have no result. Repeated rows have a result
    each and count once in the fit. Vectors of each length are a fit of their own. Eigenvalues that rounding cannot tell
    from zero (fewer vectors than dimensions; a single vector has none) give no component. Scaled entries beyond 2^52
    count as 2^52; a deviation beyond a long is null. Null ids stay; an empty table gives no rows.
    """
    arrow_batches(vectors.sparkSession)
    spark = vectors.sparkSession
    d = integer_vectors(vectors, id_col, vector_col)
    distinct = materialize(d.select("x").distinct())
    kind = dict(d.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    out = spark.createDataFrame([], schema)
    for (size,) in distinct.select(F.size("x").alias("size")).distinct().orderBy("size").collect():
        fit = distinct.where(F.size("x") == size)
        w = Whitening(*_covariance(fit, size), components)
        if not len(w.values):
            continue
        out = out.unionAll(d.where(F.size("x") == size).mapInArrow(_applied(w, _identity_error(fit, w)), schema))
    return out


def _applied(w: Whitening, error: float):
    k = len(w.values)

    def apply(batches):
        for batch in batches:
            x = _rows(batch.column("x"))
            m = len(x)
            if not m:
                continue
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n, np.int64)), pa.array(w.deviations(x), pa.int64()).take(each),
                 pa.array(w.whitened(x).ravel()), pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return apply
