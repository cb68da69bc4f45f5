"""Operator 11: embedding whitening by incremental eigendecomposition.

Entries become whole numbers x = floor(64 c) + 1000000; only x - 1000000 is ever computed
with, so means and scatters lose nothing to the offset.

1. Every partition keeps the spectrum of its centred scatter, M = Q diag(d) Q', of which a
   new vector is a rank-one update: with n vectors of mean m, M grows by n / (n + 1) times
   the square of (x - m).  The new eigenvalues are the roots of the secular equation
   1 + r sum z_j^2 / (d_j - t) = 0, found for all intervals at once; eigenvectors come
   from the z that has these roots exactly (Loewner's formula), so they stay orthogonal.
   Entries of z that are negligible, and all but one of a cluster of equal d (rotated
   together), are deflated.  ``FOLD`` vectors at a time are first turned, by a rotation of
   rows that keeps their scatter, into one update per dimension at most and one for
   their mean; FOLD = 1 applies each vector by itself.
2. Spectra are combined by successive rank-one updates: one per eigenpair of the other,
   one for the difference of the means; in groups of at most ``FAN`` partitions, in
   levels, so no task gets more than ``FAN`` spectra however many partitions there are.
3. The combined Q is a basis only.  A Rayleigh-Ritz pass over all rows computes the exact
   projection Q' V Q, every row centred by the exact mean S / n; its eigenvectors, turned
   by Q, are V's to double precision whatever the first pass has rounded.
4. A pass sums the whitened rows' moments (identity_error), a last one returns the rows.

Driver and tasks hold d x d doubles of the model and no rows.  The cost of a rank-one
update is of the order of d^3.

Defined cases: vectors that are null or empty or hold null or non-finite entries go, and
so do those with entries of 2**40 and more, whose squares have no exact sum here; the
dimension is the length that most of the others have (ties: the longer one), and vectors
of other lengths, which are points of another space, go too; repeated ids and rows are
rows of their own; a direction without variance has explained 0 and whitened null, and
explained is null when no direction has any; identity_error looks at the others, and is
null if there are none; a deviation beyond 64 bits is null; empty table: no rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiflow.llm.graph import saved_table
from regiflow.llm.neardup import _matrix

SCALE, SHIFT = 64, 1_000_000
TOP = 32
FOLD = 4096            # vectors that are rotated into at most d updates; 1: none
FAN = 32               # spectra combined in one task
LIMIT = float(1 << 40)
EPS = float(np.finfo(float).eps)


# ---------------------------------------------------------------- rank-one updates

def _roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum w_j / (d_j - t) = 0 for ascending d and positive w, one above each d_j.

    As (nearest d, offset from it): a difference d_j - t is then exact to the last bits.
    Each step takes the root of a two-pole interpolation; if that leaves the bracket, its middle.
    """
    n = len(d)
    right = np.append(d[1:], d[-1] + w.sum())
    gap = right - d
    i = np.arange(n)
    lower = np.tril(np.ones((n, n)))
    lower = lower.astype(bool)

    def at(origin, t):
        delta = d[None, :] - origin[:, None]
        near = delta - t[:, None]
        terms = w / near
        return near, terms

    middle = gap / 2
    _, terms = at(d, middle)
    left = (1 + terms.sum(1) >= 0) | (i == n - 1)         # f rises from -inf to +inf: the root is in the left half
    left[-1] = True
    origin = np.where(left, d, right)
    lo = np.where(left, 0.0, -gap / 2)
    hi = np.where(left, np.where(i == n - 1, gap, gap / 2), 0.0)
    t = np.where(left, hi, lo) / 2
    t = np.where(i == n - 1, gap / 2, t)
    other = np.append(d[1:], np.inf)
    for _ in range(60):
        near, terms = at(origin, t)
        f = 1 + terms.sum(1)
        slopes = terms / near
        psi, phi = (slopes * lower).sum(1), (slopes * ~lower).sum(1)
        lo, hi = np.where(f < 0, t, lo), np.where(f > 0, t, hi)
        done = np.abs(f) <= 4 * n * EPS * (1 + np.abs(terms).sum(1))
        done |= hi - lo <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi))
        if done.all():
            break
        a1 = near[i, i]
        a2 = other - origin - t
        with np.errstate(all="ignore"):
            c = f - a1 * psi - np.where(np.isinf(a2), 0, a2 * phi)
            a = (a1 + a2) * f - a1 * a2 * (psi + phi)
            b = a1 * a2 * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            # the last root has one pole only: c + w / (d_n - t) with the value and slope of f
            last = a1[-1] + a1[-1] ** 2 * psi[-1] / c[-1]
            step[-1] = last
        new = t + step
        bad = ~np.isfinite(new) | (new <= lo) | (new >= hi)
        new = np.where(bad, (lo + hi) / 2, new)
        t = np.where(done, t, new)
    return origin, t


def update(d: np.ndarray, q: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spectrum (ascending d, columns of q) of q diag(d) q' + rho v v', rho >= 0."""
    z = q.T @ v
    norm = float(np.sqrt(z @ z))
    if rho <= 0 or norm == 0:
        return d, q
    z, rho = z / norm, rho * norm * norm
    tol = 8 * EPS * max(float(np.abs(d).max()), rho)
    live = np.flatnonzero(rho * np.abs(z) > tol)           # deflation: z has no part along the others
    if len(live) > 1:
        close = np.flatnonzero(np.diff(d[live]) <= tol)
        if len(close):                                     # deflation: equal d are rotated until one has all of z
            q, z, d = q.copy(), z.copy(), d.copy()
            for k in close:
                a, b = live[k], live[k + 1]
                r = float(np.hypot(z[a], z[b]))
                c, s = z[b] / r, z[a] / r
                q[:, a], q[:, b] = c * q[:, a] - s * q[:, b], s * q[:, a] + c * q[:, b]
                z[a], z[b] = 0.0, r
            live = live[rho * np.abs(z[live]) > tol]
    if not len(live):
        return d, q
    dl, zl = d[live], z[live]
    origin, t = _roots(dl, rho * zl * zl)
    new = d.copy()
    new[live] = origin + t
    near = (dl[None, :] - origin[:, None]) - t[:, None]    # d_k - root_i
    n = len(live)
    if n == 1:
        vectors = np.ones((1, 1))
    else:
        # Loewner: z_k^2 = product over roots (root_j - d_k) / product over others (d_j - d_k), paired to stay near 1
        diff = dl[:, None] - dl[None, :]
        k = np.arange(n)
        below = k[:, None] < k[None, :]
        under = np.where(below, diff, np.vstack([diff[1:], np.ones((1, n))]))
        under[-1] = 1.0
        with np.errstate(all="ignore"):
            square = np.prod(-near / under, axis=0)
        exact = np.copysign(np.sqrt(np.abs(square)), zl)
        vectors = exact[None, :] / near
        vectors /= np.sqrt((vectors * vectors).sum(1))[:, None]
    q = q.copy()
    q[:, live] = q[:, live] @ vectors.T
    order = np.argsort(new, kind="stable")
    return new[order], q[:, order]


class Spectrum:
    """Count, exact sums and the eigenpairs of the centred scatter of vectors of length ``dim``."""

    def __init__(self, dim: int):
        self.n, self.sums = 0, np.zeros(dim, object)
        self.mean, self.d, self.q = np.zeros(dim), np.zeros(dim), np.eye(dim)

    def _grow(self, n: int, sums: np.ndarray, rows: np.ndarray) -> None:
        """n more vectors with these sums; the rows' squares add up to their centred scatter."""
        mean = np.array([float(s) for s in sums]) / n
        for r in rows:
            self.d, self.q = update(self.d, self.q, 1.0, r)
        if self.n:
            self.d, self.q = update(self.d, self.q, self.n * n / (self.n + n), mean - self.mean)
        self.n, self.sums = self.n + n, self.sums + sums
        self.mean = np.array([float(s) for s in self.sums]) / self.n

    def add(self, x: np.ndarray, fold: int = FOLD) -> None:
        """Vectors of whole numbers, as doubles."""
        for i in range(0, len(x), max(1, fold)):
            part = x[i:i + max(1, fold)]
            whole = part.astype(np.int64).sum(0).astype(object)
            centred = part - part.sum(0) / len(part)
            rows = np.linalg.qr(centred, mode="r") if len(part) > part.shape[1] else centred[:0] if len(part) == 1 else centred
            self._grow(len(part), whole, rows)

    def merge(self, other: "Spectrum") -> None:
        if other.n:
            keep = other.d > 0
            self._grow(other.n, other.sums, (other.q[:, keep] * np.sqrt(other.d[keep])).T)

    def row(self) -> dict:
        return {"n": self.n, "sums": [str(s) for s in self.sums], "d": self.d.tobytes(), "q": self.q.tobytes()}

    @classmethod
    def of(cls, row: dict) -> "Spectrum":
        d = np.frombuffer(row["d"])
        out = cls(len(d))
        out.n, out.sums, out.d = row["n"], np.array([int(s) for s in row["sums"]], object), d.copy()
        out.q = np.frombuffer(row["q"]).reshape(len(d), len(d)).copy()
        out.mean = np.array([float(s) for s in out.sums]) / out.n
        return out


STATE = "part long, n long, sums array<string>, d binary, q binary"


def _state(part: int, spectrum: Spectrum) -> pa.RecordBatch:
    schema = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.string())), ("d", pa.binary()), ("q", pa.binary())])
    return pa.RecordBatch.from_pylist([{"part": part} | spectrum.row()], schema)


# ---------------------------------------------------------------- passes over the rows

class Model(NamedTuple):
    n: int
    sums: list              # exact sums of x - SHIFT, per dimension
    basis: np.ndarray       # unit eigenvectors as columns, by falling eigenvalue
    values: np.ndarray      # eigenvalues of the covariance

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n.  n x - S is a whole number; where that is beyond 2**53 its rounding is relative."""
        if max(map(abs, self.sums), default=0) + self.n * (np.abs(x).max() if x.size else 0) < 2.0 ** 62:
            return (self.n * x.astype(np.int64) - np.array(self.sums, np.int64)) / self.n
        return ((self.n * x.astype(np.int64).astype(object) - np.array(self.sums, object)) / self.n).astype(float)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        top = max(map(abs, self.sums), default=0) + self.n * int(np.abs(x).max() if x.size else 0)
        if top * top * len(self.sums) < 1 << 63:
            return (((self.n * x.astype(np.int64) - np.array(self.sums, np.int64)) ** 2).sum(1)).tolist()
        out = ((self.n * x.astype(np.int64).astype(object) - np.array(self.sums, object)) ** 2).sum(1)
        return [int(v) if v < 1 << 63 else None for v in out]

    def live(self) -> np.ndarray:
        """Which components have variance, beyond what rounding leaves of none."""
        return self.values > len(self.sums) * 16 * EPS * max(float(self.values.max()), 0.0)


def points(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x: floor(64 c) as doubles) of the vectors of the commonest length, and that length."""
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.transform(
        F.col(f"`{embedding}`").cast("array<double>"), lambda c: F.when(F.abs(c) < LIMIT, SCALE * c)).alias("v"))
    rows = rows.where(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c)) & (F.size("v") > 0))
    common = rows.groupBy(F.size("v").alias("k")).count().orderBy(F.desc("count"), F.desc("k")).first()
    dim = common[0] if common else 0
    return rows.where(F.size("v") == dim).select("vec_id", F.transform("v", lambda c: F.floor(c).cast("double")).alias("x")), dim


def spectrum(rows: DataFrame, dim: int, fold: int = FOLD) -> Spectrum:
    """The combined spectrum of all rows."""
    def of_partition(batches):
        out, part = Spectrum(dim), 0
        for batch in batches:
            part = batch.column("_part")[0].as_py() if batch.num_rows else part
            if batch.num_rows:
                out.add(_matrix(batch.column("x")), fold)
        if out.n:
            yield _state(part, out)

    def combined(key, table):
        rows_ = sorted(table.to_pylist(), key=lambda r: r["part"])
        out = Spectrum.of(rows_[0])
        for r in rows_[1:]:
            out.merge(Spectrum.of(r))
        return pa.Table.from_batches([_state(key[0].as_py(), out)])

    states = saved_table(rows.select("x", F.spark_partition_id().cast("long").alias("_part")).mapInArrow(of_partition, STATE))
    while True:
        parts, last = states.agg(F.count("*"), F.max("part")).first()
        if parts <= 1:
            break
        # a group has FAN neighbouring numbers, which may have left the table with empty partitions
        states = saved_table(states.withColumn("part", F.expr(f"part div {FAN}")).groupBy("part").applyInArrow(combined, STATE))
    row = states.first()
    return Spectrum.of(row.asDict()) if row else Spectrum(dim)


def _moments(rows: DataFrame, project, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of project(x) and of its squares over all rows: partition sums, added up in levels."""
    def of_partition(batches):
        s, m, part = np.zeros(size), np.zeros((size, size)), None
        for batch in batches:
            if batch.num_rows:
                part = batch.column("_part")[0].as_py()
                y = project(_matrix(batch.column("x")))
                s += y.sum(0)
                m += y.T @ y
        if part is not None:
            yield batch_of(part, s, m)

    def batch_of(part, s, m):
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([s.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())], ["part", "s", "m"])

    def added(key, table):
        got = sorted(table.to_pylist(), key=lambda r: r["part"])
        return pa.Table.from_batches([batch_of(key[0].as_py(), sum(np.frombuffer(r["s"]) for r in got), sum(np.frombuffer(r["m"]) for r in got))])

    schema = "part long, s binary, m binary"
    sums = rows.select("x", F.spark_partition_id().cast("long").alias("_part")).mapInArrow(of_partition, schema)
    for width in (1024, FAN, 1):                              # the last level gets FAN rows, the first a share of the partitions
        sums = sums.withColumn("part", F.col("part") % width).groupBy("part").applyInArrow(added, schema)
    row = sums.first()
    return np.frombuffer(row["s"]), np.frombuffer(row["m"]).reshape(size, size)


def fit(rows: DataFrame, dim: int, fold: int = FOLD) -> Model | None:
    """Incremental spectrum, then Rayleigh-Ritz in its basis over all rows; None without rows."""
    first = spectrum(rows, dim, fold)
    if not first.n:
        return None
    basis, _ = np.linalg.qr(first.q)
    start = Model(first.n, [int(s) for s in first.sums], basis, first.d)
    _, m = _moments(rows, lambda x: start.centred(x) @ basis, dim)
    values, turn = np.linalg.eigh(m / first.n)
    values, vectors = values[::-1], (basis @ turn)[:, ::-1]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(dim)])
    return Model(first.n, start.sums, vectors * np.where(sign == 0, 1, sign), np.maximum(values, 0))


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", top: int = TOP, fold: int = FOLD) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector and component."""
    rows, dim = points(vectors, vec_id, embedding)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(rows, dim, fold) if dim else None
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    top = min(top, dim)
    live = model.live()[:top]
    scale = np.where(live, 1 / np.sqrt(np.where(live, model.values[:top], 1)), 0)
    project = lambda x: (model.centred(x) @ model.basis[:, :top]) * scale
    s, m = _moments(rows, project, top)
    error = m / model.n - np.outer(s, s) / model.n ** 2 - np.eye(top)
    error = float(np.abs(error[np.ix_(live, live)]).max()) if live.any() else None
    total = float(model.values.sum())
    explained = [float(v / total) if ok else 0.0 for v, ok in zip(model.values[:top], live)] if live.any() else [None] * top

    def of_batches(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, k = _matrix(batch.column("x")), batch.num_rows
            y = project(x)
            n_rows = k * top
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(np.repeat(np.arange(k), top))), pa.array(np.tile(np.arange(1, top + 1), k), pa.int32()),
                 pa.array(np.full(n_rows, model.n), pa.int64()), pa.array(model.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(k), top))),
                 pa.array(y.ravel(), pa.float64(), mask=~np.tile(live, k)), pa.array(explained * k, pa.float64()),
                 pa.array([error] * n_rows, pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(of_batches, schema)
