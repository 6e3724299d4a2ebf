"""Embedding whitening: leading principal components by FEAST contour integration.

Vectors become whole numbers, ``x = floor(64 * c) + 1000000``.  The fit list is each distinct x vector once (a
shuffle of the vectors, copies merged before it); its count, sums and centred covariance are sums over tasks, so only
``d`` and ``d * d`` numbers (d: the vectors' length) reach the driver.  The eigenvectors of that matrix are found so:

1. **Inertia**: the number of eigenvalues above s is the number of positive pivots of a symmetric factorisation of
   ``V - s`` (:func:`above`).  Bisection by these counts cuts the upper end of the spectrum into intervals that hold
   a few eigenvalues each.
2. **Contour integration**: for every interval, a quadrature of ``(z - V)^-1 Y`` over a circle through its ends
   projects a random block Y onto the eigenvectors inside.  Each (interval, point of the quadrature) is one complex
   shifted solve, all of them rows of one Spark job.
3. **Rayleigh-Ritz** on the projected block gives approximate pairs, the next Y; it ends when all residuals inside
   are at rounding level *and* their number is the inertia count: none is missed.  Blocks grow if one is.

A last Rayleigh-Ritz over all intervals makes the vectors orthogonal between them.

Precision: sums are exact whole numbers; x is centred by the whole part of the mean first, then by its fraction, so no
large numbers cancel.

Defined results: rows take no part if the vector is null, empty, holds a null or non-finite entry, or has not the most
common length (of equally common ones the greatest).  Components whose eigenvalue is zero up to rounding are not
returned (they cannot be scaled to variance one), so one distinct vector gives no rows; an empty table gives none.
Equal rows give equal results.  Of equal eigenvalues any orthogonal vectors are taken.  Other columns are not touched.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.shared import stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Quadrature points on the half circle, eigenvalues an interval (more only if they cannot be told apart), rounds.
POINTS, HELD, ROUNDS = 8, 8, 30
_EPS = np.finfo(float).eps


# ---------------------------------------------------------------- eigenpairs of a symmetric matrix


def above(v: np.ndarray, s: float) -> int:
    """Number of eigenvalues of ``v`` greater than ``s``: positive pivots of ``v - s`` (one or two rows a pivot)."""
    a = v - s * np.eye(len(v))
    n, k, plus = len(a), 0, 0
    near = (1 + np.sqrt(17)) / 8  # the usual balance of the growth of one- and two-row pivots

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1:, k])
        most = below.max(initial=0.0)
        own = abs(a[k, k])
        if max(own, most) == 0:
            k += 1
            continue
        two = False
        if own < near * most:
            r = k + 1 + int(below.argmax())
            beside = np.abs(a[k:, r])
            beside[r - k] = 0
            widest = beside.max()
            if own * widest < near * most * most:
                if abs(a[r, r]) >= near * widest:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    two = True
        if two:  # its determinant is negative: one eigenvalue of each sign
            plus += 1
            rest = a[k + 2:, k:k + 2]
            a[k + 2:, k + 2:] -= rest @ np.linalg.solve(a[k:k + 2, k:k + 2], rest.T)
        else:
            plus += a[k, k] > 0
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k] / a[k, k], a[k, k + 1:])
        k += 2 if two else 1
    return int(plus)


@dataclass
class Interval:
    lo: float
    hi: float
    count: int
    block: np.ndarray
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None


def intervals(v: np.ndarray, k: int, seed: int = 11) -> list[Interval]:
    """Disjoint intervals that hold the ``k`` greatest eigenvalues above rounding level (and perhaps a few more)."""
    d = len(v)
    top = float(np.abs(v).sum(1).max()) * (1 + 1e-6)
    floor = d * _EPS * top
    if not top > 0 or not np.isfinite(top):
        return []
    rank = above(v, floor)
    k = min(k, rank)
    if not k:
        return []

    def clear(s: float, width: float, sides: tuple[int, ...]) -> float:
        """A point near s (on these sides of it) with no eigenvalue close by, if there is one."""
        for i in range(20):
            for t in (s + side * i * width / 100 for side in sides):
                if t > floor and above(v, t - width / 1000) == above(v, t + width / 1000):
                    return t
        return s

    lo, hi = floor, top
    while hi - lo > 1e-12 * top:  # lo: a point with k eigenvalues or more above it, as high as may be
        mid = (lo + hi) / 2
        n = above(v, mid)
        if n >= k:
            lo = mid
            if n == k:
                break
        else:
            hi = mid
    todo, out = [(clear(lo, lo / 4, (-1,)), top)], []
    rng = np.random.default_rng(seed)
    while todo:
        a, b = todo.pop()
        n = above(v, a) - above(v, b)
        if n > HELD and b - a > 1e-10 * top:
            mid = clear((a + b) / 2, (b - a) / 4, (1, -1))
            todo += [(a, mid), (mid, b)]
        elif n:
            out.append(Interval(a, b, n, rng.standard_normal((d, min(d, 2 * n + 4)))))
    return out


def _solves(spark: SparkSession, shared, jobs: list[tuple[int, complex, complex]], blocks: list[np.ndarray]) -> dict[int, np.ndarray]:
    """Sum over an interval's points of ``Re(weight * (z - V)^-1 block)``: one row, one shifted solve."""
    task = spark.sparkContext.broadcast((jobs, blocks))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        work, held = task.value
        for batch in batches:
            for i in batch.column(0).to_pylist():
                of, z, weight = work[i]
                part = (weight * np.linalg.solve(z * np.eye(len(v)) - v, held[of].astype(complex))).real
                yield pa.RecordBatch.from_arrays([pa.array([of], pa.int32()), pa.array([np.ascontiguousarray(part).tobytes()], pa.binary())], ["i", "part"])

    rows = spark.range(len(jobs), numPartitions=len(jobs)).mapInArrow(solve, "i int, part binary").toArrow()
    out = {i: np.zeros(b.shape) for i, b in enumerate(blocks)}
    for i, part in zip(rows.column("i").to_pylist(), rows.column("part").to_pylist(), strict=True):
        out[i] += np.frombuffer(part).reshape(blocks[i].shape)
    task.unpersist()
    return out


def _ritz(v: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit vectors of ``v`` within the span of ``block``."""
    q, size, _ = np.linalg.svd(block, full_matrices=False)
    q = q[:, size > size.max(initial=0.0) * 1e-13] if len(size) else q
    q, _ = np.linalg.qr(q)
    e, u = np.linalg.eigh(q.T @ v @ q)
    return e, q @ u


def feast(spark: SparkSession, v: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` greatest eigenvalues of ``v`` above rounding level, falling, and their unit vectors (columns)."""
    d = len(v)
    parts = intervals(v, k)
    if not parts:
        return np.zeros(0), np.zeros((d, 0))
    x, w = np.polynomial.legendre.leggauss(POINTS)
    turn = np.exp(0.5j * np.pi * (1 + x))
    shared = spark.sparkContext.broadcast(v)
    size = np.abs(v).sum(1).max()
    rng = np.random.default_rng(23)
    for _ in range(ROUNDS):
        left = [p for p in parts if p.values is None]
        if not left:
            break
        jobs = []
        for i, p in enumerate(left):
            c, r = (p.lo + p.hi) / 2, (p.hi - p.lo) / 2
            jobs += [(i, complex(c + r * t), complex(r * t * wt / 2)) for t, wt in zip(turn, w, strict=True)]
        projected = _solves(spark, shared, jobs, [p.block for p in left])
        for i, p in enumerate(left):
            e, u = _ritz(v, projected[i])
            inside = (e > p.lo) & (e <= p.hi)
            close = np.linalg.norm(v @ u - u * e, axis=0) <= 16 * d * _EPS * size
            if inside.sum() == p.count and close[inside].all():
                p.values, p.vectors = e[inside], u[:, inside]
            else:  # fresh columns beside what is found already
                more = rng.standard_normal((d, max(0, min(d, p.block.shape[1] + 2) - u.shape[1])))
                p.block = np.hstack([u, more])
    if any(p.values is None for p in parts):
        raise ArithmeticError("an interval did not yield as many eigenpairs as its inertia counts")
    e, u = _ritz(v, np.hstack([p.vectors for p in parts]))
    order = np.argsort(-e)[:k]
    return e[order], u[:, order]


# ---------------------------------------------------------------- tables


def whole(vector: Column) -> Column:
    """x of a vector of finite entries."""
    return F.transform(vector, lambda c: F.floor(SCALE * c.cast("double")).cast("bigint") + SHIFT)


def _usable(df: DataFrame, vector: str, key: str) -> DataFrame:
    """(key, x) of the rows that take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(F.col(f"`{key}`").alias("key"), v.alias("v"))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("v") == (sizes["d"] if sizes else 0)).select("key", whole(F.col("v")).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, d)


def _summed(df: DataFrame, each, size: int, kind: str) -> np.ndarray:
    """Sum over all rows of ``each(x)`` (an array of ``size`` numbers): one vector a task, added up by position."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = each(batch.column(0))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "v"])

    rows = df.mapInArrow(run, f"i int, v {kind}").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size, np.int64 if kind == "bigint" else np.float64)
    out[rows.column("i").to_numpy()] = rows.column("v").to_numpy()
    return out


@dataclass
class Whitener:
    """What a fit finds: counts, exact sums, eigenvalues (falling) and vectors (columns), and how well it whitens its list."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n``: the whole part of the mean first, exactly."""
        whole_mean = self.sums // self.n
        return (x - whole_mean).astype(float) - (self.sums - self.n * whole_mean) / self.n

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum of ``(n * x - sums)**2`` of each row, exact."""
        whole_mean = self.sums // self.n
        y, f, n = x - whole_mean, self.sums - self.n * whole_mean, self.n
        if len(y) and int(np.abs(y).max()) * max(int(np.abs(y).max()), n) * y.shape[1] >= 1 << 62:
            y, f = y.astype(object), f.astype(object)
        rest = sum(int(t) ** 2 for t in f)
        return [n * n * int(a) - 2 * n * int(b) + rest for a, b in zip((y * y).sum(1), y @ f, strict=True)]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def fit(spark: SparkSession, x: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fit over the distinct vectors of the column ``x`` (whole numbers, one length); None without any."""
    listed = stored(x.select("x").distinct(), "fit")
    first = listed.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d, n = first["d"], listed.count()
    # sums of x - SHIFT: small whole numbers, however many there are
    sums = _summed(listed, lambda c: (_matrix(c, d) - SHIFT).sum(0), d, "bigint") + n * SHIFT
    out = Whitener(n, sums, 0.0, np.zeros(0), np.zeros((d, 0)))
    upper = np.triu_indices(d)

    def products(c: pa.Array) -> np.ndarray:
        y = out.centred(_matrix(c, d))
        return (y.T @ y)[upper]

    v = np.zeros((d, d))
    v[upper] = _summed(listed, products, len(upper[0]), "double") / n
    v = np.triu(v) + np.triu(v, 1).T
    out.trace = float(np.trace(v))
    out.values, out.vectors = feast(spark, v, components)
    k = len(out.values)

    def moments(c: pa.Array) -> np.ndarray:
        z = out.whitened(_matrix(c, d))
        return np.concatenate([z.sum(0), (z.T @ z).ravel()])

    if k:
        seen = _summed(listed, moments, k + k * k, "double") / n
        mean = seen[:k]  # zero up to rounding: z is linear in what is centred
        out.identity_error = float(np.abs(seen[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())
    return out


SCHEMA = "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(df: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """(key, component from 1, n, deviation, whitened, explained, identity_error): ``components`` rows per row that takes part."""
    rows = _usable(df, vector, key)
    schema = f"key {rows.schema['key'].dataType.simpleString()}, {SCHEMA}"
    model = fit(df.sparkSession, rows, components)
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    d, k = len(model.sums), len(model.values)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), d)
            row = np.repeat(np.arange(len(x)), k)
            of = np.tile(np.arange(k), len(x))
            spread = pa.array(m.deviation(x), pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row)), pa.array((of + 1).astype(np.int32)), pa.array(np.full(len(row), m.n)), spread.take(pa.array(row)),
                pa.array(m.whitened(x).ravel()), pa.array((m.values / m.trace)[of]), pa.array(np.full(len(row), m.identity_error))],
                ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, schema)
