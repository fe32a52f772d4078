"""Embedding whitening through a bidiagonal qd solver.

1. Every task centres its rows and reduces them block by block to a triangle R
   with the rows' Gram matrix (R'R = sum of outer products); triangles are
   stacked and reduced again in groups, so one triangle of width x width is
   left. The covariance is R'R / n and is never formed.
2. R = U B V' by Householder reflections, B upper bidiagonal.
3. The squared singular values of B come from dqds (differential qd with
   shifts), which keeps their relative accuracy.
4. For each value the stationary and progressive qd transforms of B'B meet in
   a twisted factorisation, whose twist with the smallest pivot gives the
   right singular vector of B; V turns it into a direction. Vectors of
   neighbouring values are made orthogonal to each other.

Steps 2 to 4 work on one matrix of width x width. Centring is exact: rows are
integers, floor(scale * x), and n * row - sum is taken in integers.

Semantics: rows whose vector is null or holds a null or non-finite component
are dropped; rows that repeat an id are rows of their own and all count.
Shorter vectors are padded with zeros. Components are numbered from 1 by
falling variance and point so that their largest coordinate (the first, if
several) is positive. A component whose variance is under 1e-13 of the largest
has no whitened value and is left out, so equal rows give none at all.
Deviations are exact as long as they fit 63 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aurum.llm.common import materialise, ship_by_value
from aurum.llm.lloyd import padded, whole

ship_by_value(__name__)

SCALE, COMPONENTS = 64, 32
#: rows reduced at once; triangles reduced by one task
BLOCK_ROWS, FAN_IN = 4096, 32
EPS = float(np.finfo(float).eps)
LEAST_SHARE = 1e-13
#: relative distance under which two values are neighbours
NEAR = 1e-3


# ------------------------------------------------------------------ the solver (one small matrix)

def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with r = U B V', by Householder reflections from both sides."""
    a = np.array(r, np.float64)
    n = a.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        tail = float(np.abs(x[1:]).max(initial=0.0))
        if tail == 0.0:
            return None
        u = x / max(tail, abs(float(x[0])))
        u[0] += math.copysign(float(np.linalg.norm(u)), u[0])
        return u / np.linalg.norm(u)

    for k in range(n):
        u = reflector(a[k:, k].copy())
        if u is not None:
            a[k:, k:] -= 2.0 * np.outer(u, u @ a[k:, k:])
        if k < n - 2:
            u = reflector(a[k, k + 1:].copy())
            if u is not None:
                a[k:, k + 1:] -= 2.0 * np.outer(a[k:, k + 1:] @ u, u)
                v[:, k + 1:] -= 2.0 * np.outer(v[:, k + 1:] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def dqds(diag: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling.

    Each sweep turns the qd array of B'B - shift into the next one. A shift that
    makes a pivot negative lies over the least value and is made smaller; a
    negligible off-diagonal at the end frees a value, one in the middle splits
    the array.
    """
    found: list[float] = []
    todo = [([float(x) ** 2 for x in diag], [float(x) ** 2 for x in above], 0.0)]
    while todo:
        q, e, shift = todo.pop()
        pivot = 0.0  # least pivot of the last sweep: bounds the least value from above
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + shift)
                break
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= EPS * EPS * (shift + q[i])), None)
            if cut is not None:
                if cut == n - 2:
                    found.append(q.pop() + shift)
                    e.pop()
                else:
                    todo.append((q[:cut + 1], e[:cut], shift))
                    q, e = q[cut + 1:], e[cut + 1:]
                pivot = 0.0
                continue
            # lower eigenvalue of the last 2 x 2 corner, kept under the last pivot
            a, b, c = q[-2] + (e[-2] if n > 2 else 0.0), q[-2] * e[-1], q[-1] + e[-1]
            half = 0.5 * (a - c)
            root = c - b / (half + math.copysign(math.hypot(half, math.sqrt(b)), half)) if b > 0.0 else min(a, c)
            step = max(0.0, min(root, pivot if pivot > 0.0 else root) * 0.98)
            while True:
                got = _sweep(q, e, step)
                if got is not None:
                    break
                step = step / 4 if step > EPS * q[0] * 1e-3 else 0.0
            q, e, pivot = got
            shift += step
    return np.sort(np.maximum(np.array(found), 0.0))[::-1]


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    d, least, nq, ne = q[0] - shift, math.inf, [], []
    for i, off in enumerate(e):
        if d < 0.0:
            return None
        least = min(least, d)
        pivot = d + off
        ratio = q[i + 1] / pivot if pivot > 0.0 else 0.0
        nq.append(pivot)
        ne.append(off * ratio)
        d = d * ratio - shift if pivot > 0.0 else q[i + 1] - shift
    if d < 0.0:
        return None
    return [*nq, d], ne, min(least, d)


def twisted(diag: np.ndarray, above: np.ndarray, value: float, seed: np.ndarray | None = None) -> np.ndarray:
    """Unit right singular vector of B for the squared singular value ``value``.

    With ``seed`` the factorisation solves for that right-hand side instead of
    the unit vector at the twist (a step of inverse iteration).
    """
    n = len(diag)
    tiny = max(float((diag ** 2).max(initial=0.0)), 1e-300) * EPS * EPS
    big = np.where(diag ** 2 > tiny, diag ** 2, tiny)  # D of B'B = L D L'
    low = above * (np.where(diag ** 2 > tiny, diag, math.sqrt(tiny)) / big)[:-1]  # subdiagonal of L

    def safe(x: float) -> float:
        return x if abs(x) > tiny else math.copysign(tiny, x)

    s, plus, lplus = np.zeros(n), np.zeros(n), np.zeros(max(0, n - 1))
    s[0] = -value
    for i in range(n):
        plus[i] = safe(s[i] + big[i])
        if i < n - 1:
            lplus[i] = big[i] * low[i] / plus[i]
            s[i + 1] = lplus[i] * low[i] * s[i] - value
    p, minus, uminus = np.zeros(n), np.zeros(n), np.zeros(max(0, n - 1))
    p[-1] = big[-1] - value
    for i in range(n - 2, -1, -1):
        minus[i + 1] = safe(big[i] * low[i] ** 2 + p[i + 1])
        t = big[i] / minus[i + 1]
        uminus[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    k = int(np.abs(s + p + value).argmin())
    z = np.zeros(n)
    if seed is None:
        z[k] = 1.0
    else:  # N D N' z = seed with the twisted factor N: both sweeps run towards the twist
        y = seed.copy()
        for i in range(k):
            y[i + 1] -= lplus[i] * y[i]
        for i in range(n - 2, k - 1, -1):
            y[i] -= uminus[i] * y[i + 1]
        z[:k], z[k + 1:] = y[:k] / plus[:k], y[k + 1:] / minus[k + 1:]
        z[k] = y[k] / safe(float(s[k] + p[k] + value))
    for i in range(k - 1, -1, -1):
        z[i] -= lplus[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] -= uminus[i] * z[i]
    z /= np.abs(z).max()
    return z / np.linalg.norm(z)


def _beside(diag: np.ndarray, above: np.ndarray, value: float, near: np.ndarray) -> np.ndarray:
    """The vector of ``value``, orthogonal to those of neighbouring values found before."""
    def away(x: np.ndarray) -> tuple[np.ndarray, float]:
        for _ in range(2):
            x = x - near @ (near.T @ x)
        size = float(np.linalg.norm(x))
        return (x / size, size) if size > 0.0 else (x, 0.0)

    z, size = away(twisted(diag, above, value))
    # numerically equal values give one vector: iterate beside those found
    rng = np.random.default_rng(len(diag))
    for _ in range(6):
        if size > 0.5:
            break
        z, size = away(twisted(diag, above, value, z if size > 1e-6 else away(rng.standard_normal(len(diag)))[0]))
    return away(z)[0]


def principal(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues of r'r (falling, at most ``count``) and their unit eigenvectors as columns."""
    scale = float(np.abs(r).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(0), np.zeros((r.shape[1], 0))
    diag, above, v = bidiagonalise(r / scale)
    # blocks that a negligible superdiagonal separates have vectors of their own
    edges = [0, *(np.flatnonzero(np.abs(above) <= EPS * max(np.abs(diag).max(), np.abs(above).max(initial=0.0))) + 1), len(diag)]
    parts = [(float(x), k, a, b) for a, b in zip(edges, edges[1:]) for k, x in enumerate(dqds(diag[a:b], above[a:b - 1]))]
    parts.sort(key=lambda x: (-x[0], x[2], x[1]))
    parts = [x for x in parts[:count] if x[0] > LEAST_SHARE * parts[0][0]]
    values, vectors = np.array([x[0] for x in parts]), np.zeros((len(diag), len(parts)))
    for k, (value, _, a, b) in enumerate(parts):
        near = [j for j in range(k) if parts[j][2] == a and values[j] - value <= NEAR * values[j]]
        vectors[a:b, k] = _beside(diag[a:b], above[a:b - 1], value, vectors[a:b, near])
    out = v @ vectors
    out *= np.sign(out[np.abs(out).argmax(0), np.arange(len(parts))])
    return values * scale * scale, out


# ------------------------------------------------------------------ Spark side

def _ints(column: pa.Array, width: int, scale: int) -> np.ndarray:
    return np.floor(padded(column, width) * scale).astype(np.int64)


def _moments(width: int, scale: int):
    def run(batches):
        n, s = 0, np.zeros(width, np.int64)
        for b in batches:
            x = _ints(b.column("_e"), width, scale)
            n, s = n + len(x), s + x.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, width), pa.int32()), pa.array(np.append(n, s), pa.int64())], names=["place", "s"])
    return run


def _centred(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    return (n * x - s) / float(n)


def _triangle(n: int, s: np.ndarray, scale: int):
    def run(batches):
        r = np.zeros((0, len(s)))
        for b in batches:
            x = _centred(_ints(b.column("_e"), len(s), scale), n, s)
            for at in range(0, len(x), BLOCK_ROWS):
                r = np.linalg.qr(np.vstack([r, x[at:at + BLOCK_ROWS]]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["k", "r"])
    return run


def _reduce(width: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by("k")
        r = np.zeros((0, width))
        for raw in rows.column("r").to_pylist():
            r = np.linalg.qr(np.vstack([r, np.frombuffer(raw).reshape(-1, width)]), mode="r")
        return pa.table({"k": pa.array([rows.column("k")[0].as_py() // FAN_IN], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})
    return run


def _triangles_to_one(rows: DataFrame, n: int, s: np.ndarray, scale: int) -> np.ndarray:
    """The triangle of all centred rows: one per task, then groups of FAN_IN until one is left."""
    width = len(s)
    level = materialise(rows.mapInArrow(_triangle(n, s, scale), "k long, r binary"), "whitening-triangles")
    while level.count() > FAN_IN:
        level = materialise(level.groupBy(F.expr(f"k div {FAN_IN}")).applyInArrow(_reduce(width), "k long, r binary"), "whitening-triangles")
    r = np.zeros((0, width))
    for row in level.orderBy("k").collect():  # at most FAN_IN triangles
        r = np.linalg.qr(np.vstack([r, np.frombuffer(bytes(row["r"])).reshape(-1, width)]), mode="r")
    return np.vstack([r, np.zeros((width - len(r), width))])


class Whitener:
    """A fitted whitening: row count, exact sums, variances, directions (columns already over the root of the variance)."""

    def __init__(self, n: int, sums: np.ndarray, values: np.ndarray, vectors: np.ndarray, trace: float, scale: int):
        self.n, self.sums, self.values, self.trace, self.scale = n, sums, values, trace, scale
        self.vectors = vectors
        self.project = vectors / np.sqrt(values) if len(values) else vectors


def fit(df: DataFrame, embedding: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Whitener:
    """Whitening fitted to all whole vectors of ``df``."""
    rows = df.select(F.col(embedding).alias("_e")).where(whole(F.col("_e")))
    width = rows.agg(F.max(F.size("_e"))).first()[0] or 0
    if not width:
        return Whitener(0, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0)), 0.0, scale)
    got = {r["place"]: r["s"] for r in rows.mapInArrow(_moments(width, scale), "place int, s long").groupBy("place").agg(F.sum("s").alias("s")).collect()}
    n, sums = got[-1], np.array([got[k] for k in range(width)], np.int64)
    r = _triangles_to_one(rows, n, sums, scale)
    values, vectors = principal(r / math.sqrt(n), components)
    return Whitener(n, sums, values, vectors, float((r * r).sum()) / n, scale)


def identity_error(df: DataFrame, w: Whitener, embedding: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""
    width, k = w.project.shape
    if not k:
        return 0.0
    n, s, project, scale = w.n, w.sums, w.project, w.scale

    def run(batches):
        total, outer = np.zeros(k), np.zeros((k, k))
        for b in batches:
            y = _centred(_ints(b.column("_e"), width, scale), n, s) @ project
            total, outer = total + y.sum(0), outer + y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k + k), pa.int32()), pa.array(np.append(outer.ravel(), total))], names=["place", "s"])

    rows = df.select(F.col(embedding).alias("_e")).where(whole(F.col("_e")))
    got = rows.mapInArrow(run, "place int, s double").groupBy("place").agg(F.sum("s").alias("s")).orderBy("place").collect()
    flat = np.array([r["s"] for r in got])
    mean = flat[k * k:] / n
    return float(np.abs(flat[:k * k].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())


def transform(df: DataFrame, w: Whitener, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, component, deviation, whitened): a row per whole vector and component (a narrow map)."""
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("_e")).where(whole(F.col("_e")))
    out = rows.drop("_e").withColumns({"component": F.lit(0), "deviation": F.lit(0).cast("long"), "whitened": F.lit(0.0)}).schema
    width, k = w.project.shape
    if not k:
        return rows.limit(0).drop("_e").withColumns({"component": F.lit(0), "deviation": F.lit(0).cast("long"), "whitened": F.lit(0.0)})
    n, s, project, scale = w.n, w.sums, w.project, w.scale

    def run(batches):
        for b in batches:
            off = n * _ints(b.column("_e"), width, scale) - s
            y = (off / float(n)) @ project
            at = np.repeat(np.arange(len(off)), k)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1), len(off)), pa.int32()),
                 pa.array((off * off).sum(1)[at], pa.int64()), pa.array(y.ravel())], names=["vec_id", "component", "deviation", "whitened"])

    return rows.mapInArrow(run, out)


def whiten(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every whole vector."""
    w = fit(df, embedding, components, scale)
    error = identity_error(df, w, embedding)
    share = F.array(*[F.lit(float(v / w.trace)) for v in w.values]) if len(w.values) else F.array().cast("array<double>")
    return transform(df, w, vec_id, embedding).select(
        "vec_id", "component", F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("component") - 1).alias("explained"), F.lit(error).alias("identity_error"))
