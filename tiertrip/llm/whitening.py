"""Whitening of embeddings by an incremental eigendecomposition.

Every component c becomes the integer ``floor(scale * c) + offset``. Each task keeps the mean and the
spectrum of the rows it has read: a row changes the scatter matrix by one centred rank-one term, whose
new eigenvalues are the roots of a secular equation between the old ones (small terms and equal
eigenvalues are deflated first) and whose eigenvectors follow from the roots. The tasks' spectra are
combined in a tree, 16 at a time, by the same rank-one updates: one for each eigenpair of the other
side and one for the difference of the means. The joint eigenvectors are then a basis in which one more
distributed pass over the rows gives the projected covariance (Rayleigh-Ritz), nearly diagonal, whose
small eigenproblem gives the components to double precision. Means and sums are exact integers.

A state is one d x d matrix, the same for any number of rows; only the last one comes to the driver.

Rows: a vector that is NULL, empty, or holds a NULL or non-finite entry is dropped, and so is one whose
length is not the most frequent length (of equally frequent ones the longest). Entries past 2^40 after
scaling count as 2^40. NULL and repeated ids are kept; each row counts once. A component whose
eigenvalue is zero to double precision (constant columns, fewer rows than dimensions, one row) has NULL
values in ``whitened`` and is left out of the identity check; with no spread at all ``explained`` is NULL
too. Extra columns are not read. An empty table gives no row.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import col, stash

EPS = np.finfo(float).eps
BOUND = 1 << 40
#: States combined by one group.
FAN = 16


def secular_roots(poles: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + rho * sum(z_i^2 / (poles_i - x)), for rising distinct poles and no zero z, as
    (origin, step): root j is ``poles[origin[j]] + step[j]``, the origin being its nearer pole.

    All roots are iterated at once: the sums left and right of a root are each replaced by a pole with the
    same value and slope there, whose quadratic gives the next point; a bracket keeps it in its interval."""
    n = len(poles)
    w = rho * z * z
    top = poles[-1] + w.sum()
    right_pole = np.append(poles[1:], top)
    middle = (poles + right_pole) / 2
    at_middle = 1 + (w[:, None] / (poles[:, None] - middle)).sum(0)
    near_right = (at_middle < 0) & (np.arange(n) < n - 1)
    origin = np.arange(n) + near_right
    delta = poles[:, None] - poles[origin]
    left, right = poles - poles[origin], right_pole - poles[origin]
    half = middle - poles[origin]
    lo, hi = np.where(near_right | (at_middle < 0), half, left), np.where(near_right | (at_middle < 0), right, half)
    x = (lo + hi) / 2
    below = (np.arange(n)[:, None] <= np.arange(n)).astype(float)
    weight, ones = w[:, None], np.ones(n)
    for _ in range(40):
        gap = delta - x
        term = weight / gap
        slope = term / gap
        f = 1 + ones @ term
        psi = np.einsum("ij,ij->j", slope, below)
        phi = ones @ slope - psi
        settled = np.abs(f) <= 1e-14 * n * (1 + ones @ np.abs(term))  # rounding is all that is left
        if settled.all():
            break
        lo, hi = np.where(f < 0, x, lo), np.where(f < 0, hi, x)
        dl, dr = left - x, right - x
        c = f - dl * psi - dr * phi
        a, b = c * (dl + dr) + dl * dl * psi + dr * dr * phi, dl * dr * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = dl[-1] * f[-1] / (f[-1] - dl[-1] * psi[-1])  # no pole on its right
        new = x + step
        new = np.clip(new, lo, hi)
        stuck = ~np.isfinite(new) | (new == left) | (new == right) | (new == x)
        x = np.where(settled, x, np.where(stuck, (lo + hi) / 2, new))
    return origin, x


def rank_one(lam: np.ndarray, q: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising eigenvalues and eigenvectors of ``q diag(lam) q' + rho v v'`` (rho >= 0)."""
    z = q.T @ v
    size = float(z @ z)
    if rho * size <= 0:
        return lam, q
    z, rho = z / math.sqrt(size), rho * size
    small = 8 * EPS * max(abs(float(lam[-1])), rho)
    # Equal eigenvalues: a reflection of their eigenvectors leaves the term on one of them.
    gaps = np.flatnonzero(np.diff(lam) > small) + 1
    if len(gaps) < len(lam) - 1:
        q = q.copy()
        for begin, end in zip(np.append(0, gaps), np.append(gaps, len(lam))):
            part = z[begin:end]
            length = float(np.sqrt(part @ part))
            if end - begin > 1 and length > 0:
                u = part.copy()
                u[-1] += math.copysign(length, u[-1])
                u /= np.sqrt(u @ u)
                q[:, begin:end] -= 2 * np.outer(q[:, begin:end] @ u, u)
                z[begin:end - 1] = 0
                z[end - 1] = -math.copysign(length, part[-1])
    live = np.flatnonzero(rho * np.abs(z) > small)  # the rest of the eigenpairs stay as they are
    if not len(live):
        return lam, q
    poles, zl = lam[live], z[live]
    n = len(live)
    origin, step = secular_roots(poles, zl, rho)
    gap = poles[:, None] - poles[origin] - step  # poles minus roots, without cancellation
    # The term for which the computed roots are exact keeps the vectors orthogonal.
    between = poles - poles[:, None]  # [i, j] = pole j - pole i
    between[np.arange(n), np.arange(n)] = 1
    exact = np.sqrt(np.abs(np.prod(-gap / between, axis=1)))
    vectors = np.copysign(exact, zl)[:, None] / gap
    vectors /= np.sqrt((vectors * vectors).sum(0))
    lam, q = lam.copy(), q.copy()
    q[:, live] = q[:, live] @ vectors
    lam[live] = poles[origin] + step
    order = np.argsort(lam, kind="stable")
    return lam[order], q[:, order]


class Spectrum:
    """Rows seen: their count, exact sums about an integer pivot, and the eigenpairs of their scatter."""

    def __init__(self, pivot: np.ndarray):
        d = len(pivot)
        self.n, self.pivot, self.sums = 0, pivot.astype(np.int64), [0] * d
        self.mean, self.lam, self.q = np.zeros(d), np.zeros(d), np.eye(d)  # the mean is about the pivot

    def add(self, rows: np.ndarray) -> None:
        y = rows - self.pivot
        self.sums = [a + b for a, b in zip(self.sums, y.sum(0).tolist())]
        for r in y.astype(float):
            off = r - self.mean
            if self.n:
                self.lam, self.q = rank_one(self.lam, self.q, self.n / (self.n + 1), off)
            self.n += 1
            self.mean = self.mean + off / self.n

    def merge(self, other: "Spectrum") -> None:
        for value, vector in zip(other.lam, other.q.T):
            if value > 0:
                self.lam, self.q = rank_one(self.lam, self.q, float(value), vector)
        off = (other.pivot - self.pivot) + other.mean - self.mean
        both = self.n + other.n
        self.lam, self.q = rank_one(self.lam, self.q, self.n / both * other.n, off)
        shift = (other.pivot - self.pivot).tolist()
        self.sums = [a + b + other.n * s for a, b, s in zip(self.sums, other.sums, shift)]
        self.mean = self.mean + off * (other.n / both)
        self.n = both

    def dump(self) -> bytes:
        head = json.dumps({"n": self.n, "pivot": self.pivot.tolist(), "sums": self.sums}).encode()
        return len(head).to_bytes(8, "little") + head + np.concatenate([self.mean, self.lam, self.q.ravel()]).astype("<f8").tobytes()

    @classmethod
    def load(cls, raw: bytes) -> "Spectrum":
        size = int.from_bytes(raw[:8], "little")
        head = json.loads(raw[8:8 + size])
        out = cls(np.array(head["pivot"], np.int64))
        d = len(out.pivot)
        x = np.frombuffer(raw[8 + size:], "<f8")
        out.n, out.sums = head["n"], head["sums"]
        out.mean, out.lam, out.q = x[:d].copy(), x[d:2 * d].copy(), x[2 * d:].reshape(d, d).copy()
        return out

    def total(self) -> list[int]:
        """Exact sums of the rows."""
        return [s + self.n * p for s, p in zip(self.sums, self.pivot.tolist())]


class Moments:
    """Count, mean and scatter of rows of doubles, combined from parts."""

    def __init__(self, n: int, mean: np.ndarray, scatter: np.ndarray):
        self.n, self.mean, self.scatter = n, mean, scatter

    @classmethod
    def of(cls, rows: np.ndarray) -> "Moments":
        mean = rows.mean(0)
        return cls(len(rows), mean, (rows - mean).T @ (rows - mean))

    def merge(self, other: "Moments") -> None:
        off, both = other.mean - self.mean, self.n + other.n
        self.scatter = self.scatter + other.scatter + np.outer(off, off) * (self.n / both * other.n)
        self.mean, self.n = self.mean + off * (other.n / both), both

    def dump(self) -> bytes:
        return self.n.to_bytes(8, "little") + np.concatenate([self.mean, self.scatter.ravel()]).astype("<f8").tobytes()

    @classmethod
    def load(cls, raw: bytes) -> "Moments":
        x = np.frombuffer(raw[8:], "<f8")
        d = (math.isqrt(1 + 4 * len(x)) - 1) // 2
        return cls(int.from_bytes(raw[:8], "little"), x[:d].copy(), x[d:].reshape(d, d).copy())


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), -1)


def _reduce(rows: DataFrame, state, kind, name: str):
    """One state for each task by ``state(matrix, state before or None)``, combined in a tree by slot order."""
    def part(batches):
        from pyspark import TaskContext
        found = None
        for b in batches:
            if b.num_rows:
                found = state(_matrix(b.column(0)), found)
        if found is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()]), pa.array([found.dump()], pa.binary())],
                                  names=["slot", "state"])

    def merge(key, table):
        states = table.sort_by("slot").column("state").to_pylist()
        found = kind.load(states[0])
        for raw in states[1:]:
            found.merge(kind.load(raw))
        return pa.table({"slot": pa.array([key[0].as_py()], pa.int64()), "state": pa.array([found.dump()], pa.binary())})

    states = stash(rows.select("x").mapInArrow(part, "slot long, state binary"), name)
    slots = states.agg(F.max("slot")).first()[0]
    if slots is None:
        return None
    slots += 1
    while slots > 1:
        states = states.groupBy(F.floor(F.col("slot") / FAN).alias("to")).applyInArrow(merge, "slot long, state binary")
        slots = -(-slots // FAN)
    return kind.load(states.first()["state"])


def integer_rows(table: DataFrame, scale: int, offset: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the whole vectors of the most frequent length; ``x`` as little-endian 64-bit integers."""
    v = col(vector).cast("array<double>")
    whole = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    picked = table.select(col(vec_id).alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0)).where(whole)
    common = picked.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    picked = picked.where(F.size("v") == (common["d"] if common else 0))

    def run(batches):
        for b in batches:
            v = b.column(1)
            if b.num_rows:
                with np.errstate(over="ignore"):
                    c = np.floor(scale * v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1))
                x = np.clip(c, -BOUND, BOUND).astype("<i8") + offset
                yield pa.record_batch([b.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["vec_id", "x"])

    kind = picked.schema["vec_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"vec_id {kind}, x binary")


class Whitener:
    """Components (columns), their eigenvalues, and the exact centre of the fitted rows."""

    def __init__(self, n: int, total: list[int], basis: np.ndarray, values: np.ndarray, trace: float):
        self.n, self.total, self.basis, self.values, self.trace = n, total, basis, values, trace
        self.pivot = np.array([(2 * s + n) // (2 * n) for s in total], np.int64)  # the mean, rounded
        self.rest = [s - n * int(p) for s, p in zip(total, self.pivot)]
        self.off = np.array([r / n for r in self.rest])

    def centred(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.pivot) - self.off

    def whiten(self, rows: np.ndarray) -> np.ndarray:
        """Projections over the root of the eigenvalue; NaN where the eigenvalue is zero."""
        y = self.centred(rows) @ self.basis
        with np.errstate(all="ignore"):
            return np.where(self.live, y / np.sqrt(np.where(self.live, self.values, 1)), np.nan)

    @property
    def live(self) -> np.ndarray:
        return self.values > 64 * EPS * max(self.trace, 0)

    def deviations(self, rows: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S)^2, exact."""
        y = rows - self.pivot
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.rest))
        exact = most * most * rows.shape[1] < 1 << 63
        kind = np.int64 if exact else object
        z = y.astype(kind) * self.n - np.array(self.rest, kind)
        return (z * z).sum(1).tolist()


def fit(rows: DataFrame, components: int) -> Whitener | None:
    """The leading components of ``integer_rows``; None without a row."""
    def grow(x, before):
        found = before or Spectrum(x[0])
        found.add(x)
        return found

    start = _reduce(rows, grow, Spectrum, "whitening-spectra")
    if start is None:
        return None
    basis = np.linalg.qr(start.q)[0]  # orthonormal to the last bit
    whole = Whitener(start.n, start.total(), basis, np.ones(len(basis)), 1.0)

    def projected(x, before):
        y = whole.centred(x) @ whole.basis
        found = Moments(len(x), np.zeros(y.shape[1]), y.T @ y)  # centred already: the means are zero
        if before is not None:
            found.merge(before)
        return found

    ritz = _reduce(rows, projected, Moments, "whitening-ritz").scatter / start.n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(len(values))] < 0, -1, 1)
    trace = float(values.sum())
    return Whitener(start.n, whole.total, vectors[:, :components], values[:components], trace)


def identity_error(rows: DataFrame, fitted: Whitener) -> float:
    """The largest entry of the whitened rows' covariance minus the identity, over components with spread."""
    live = fitted.live

    def gather(x, before):
        found = Moments.of(fitted.whiten(x)[:, live])
        if before is not None:
            before.merge(found)
            return before
        return found

    if not live.any():
        return 0.0
    seen = _reduce(rows, gather, Moments, "whitening-check")
    return float(np.abs(seen.scatter / seen.n - np.eye(int(live.sum()))).max())


def whiten(table: DataFrame, components: int = 32, scale: int = 64, offset: int = 1_000_000, vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """One row for each whole vector: ``vec_id, n, deviation`` (decimal), ``whitened`` and ``explained`` (an entry for each component), ``identity_error``."""
    spark: SparkSession = table.sparkSession
    rows = integer_rows(table, scale, offset, vec_id, vector)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, n long, deviation string, whitened array<double>, explained array<double>, identity_error double"
    rows = stash(rows, "whitening-rows")
    fitted = fit(rows, components)
    if fitted is None:
        out = spark.createDataFrame([], schema)
    else:
        error = identity_error(rows, fitted)
        share = [v / fitted.trace if fitted.trace > 0 else None for v in fitted.values.tolist()]

        def run(batches):
            for b in batches:
                if b.num_rows:
                    x = _matrix(b.column(1))
                    w = fitted.whiten(x)
                    flat = pa.array(w.ravel(), mask=np.isnan(w.ravel()))
                    ends = pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32())
                    yield pa.record_batch([
                        b.column(0), pa.array([fitted.n] * len(x), pa.int64()), pa.array([str(v) for v in fitted.deviations(x)]),
                        pa.ListArray.from_arrays(ends, flat), pa.array([share] * len(x), pa.list_(pa.float64())),
                        pa.array([error] * len(x), pa.float64())],
                        names=["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

        out = rows.mapInArrow(run, schema)
    return out.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))
