"""Embedding whitening by QDWH spectral divide and conquer.

Spark passes over the vectors give their exact sums and their covariance.  The
covariance (d x d, bounded by the vectors' length) is then split on the driver:
the polar factor of the shifted covariance, found by QR-based dynamically
weighted Halley iterations, is the matrix sign function; half of it plus the
identity is the projector on the invariant subspace above the shift.  Each
subspace is split again until single components are left.  The components are
broadcast and every row is whitened by them.

Entries become longs, ``x = floor(256*c) + 0``.  The fit list is each distinct
x vector once; hot copies fold before the shuffle.

Defined results: rows whose vector is null or holds a null or non-finite entry
are dropped; so are rows whose length is not the most common one among distinct
vectors (the larger of two equally common); repeated rows give repeated
results.  A component without variance (one distinct vector, or fewer
directions than components) has null ``whitened``; without any variance
``explained`` is null too, and without any component ``identity_error``.  A
``deviation`` beyond 64 bits is null.  An empty table gives no row.  Other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.tables import only
from salesmart.llm.textops import freed
from salesmart.session import materialize

EPS = np.finfo(float).eps


# -- QDWH ---------------------------------------------------------------------

def polar_factor(a: np.ndarray, max_rounds: int = 30) -> np.ndarray:
    """Orthogonal polar factor of a square matrix by QDWH."""
    n = len(a)
    x = a / np.linalg.norm(a)
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = EPS
    low = min(max(low, EPS / n), 1.0)
    eye = np.eye(n)
    for _ in range(max_rounds):
        sq = low * low
        d = np.cbrt(4 * (1 - sq) / (sq * sq))
        root = np.sqrt(1 + d)
        p = root + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - sq) / (sq * root))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        basis = np.linalg.qr(np.vstack([np.sqrt(r) * x, eye]))[0]
        new = (q / r) * x + (p - q / r) / np.sqrt(r) * (basis[:n] @ basis[n:].T)
        low = min(low * (p + q * sq) / (1 + r * sq), 1.0)
        moved, x = np.linalg.norm(new - x), new
        if moved <= np.cbrt(EPS) and abs(1 - low) <= 10 * EPS:
            break
    return x


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, int]:
    """An orthonormal basis whose first columns span the invariant subspace
    of the larger eigenvalues, and their number (1 .. n-1)."""
    n = len(a)
    values = np.diag(a)
    mean = values.mean()
    spread = np.sqrt(max(np.sum(a * a) / n - mean * mean, 0))
    shifts = [np.median(values), mean, *(mean + spread * t for t in (0.37, -0.37, 0.73, -0.73, 0.11, -0.11))]
    rng = np.random.default_rng(7)
    best = None
    for s in shifts:
        shifted = a - s * np.eye(n)
        if np.linalg.norm(shifted) <= EPS * scale:
            continue
        sign = polar_factor(shifted)
        projector = (sign + sign.T + 2 * np.eye(n)) / 4
        k = round(float(np.trace(projector)))
        if not 0 < k < n:
            continue
        mixed = rng.standard_normal((n, n))
        span = np.hstack([projector @ mixed[:, :k], mixed[:, k:] - projector @ mixed[:, k:]])
        basis = np.linalg.qr(span)[0]
        left = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k])
        if best is None or left < best[0]:
            best = (left, basis, k)
        if left <= 16 * n * EPS * scale:
            break
    if best is None:
        raise ArithmeticError("no shift splits the covariance")
    return best[1], best[2]


def components(cov: np.ndarray, want: int, scale: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenvalues of a symmetric matrix, falling, and
    their unit eigenvectors as columns.  Subspaces that hold none of them are
    not split further."""
    n = len(cov)
    want = min(want, n)
    cov = (cov + cov.T) / 2
    scale = float(np.linalg.norm(cov)) if scale is None else scale
    off = np.linalg.norm(cov - np.diag(np.diag(cov)))
    if off <= EPS * scale:
        order = np.argsort(-np.diag(cov), kind="stable")[:want]
        return np.diag(cov)[order], np.eye(n)[:, order]
    basis, k = _split(cov, scale)
    values, vectors = [], []
    for part, need in ((basis[:, :k], min(want, k)), (basis[:, k:], want - min(want, k))):
        if need:
            got, inner = components(part.T @ cov @ part, need, scale)
            values.append(got)
            vectors.append(part @ inner)
    values, vectors = np.concatenate(values), np.hstack(vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# -- Spark passes -------------------------------------------------------------

def quantised(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows whose vector is whole and finite."""
    def finite(c):
        v = c.cast("double")
        return c.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))

    whole = only(rows, "vec_id", vector).where(F.col(vector).isNotNull() & F.forall(vector, finite))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * 256.0).cast("long") + F.lit(0).cast("long"))
    return whole.select("vec_id", x.alias("x"))


def _matrix(b: pa.RecordBatch) -> np.ndarray:
    return b["x"].flatten().to_numpy(zero_copy_only=False).reshape(len(b["x"]), -1)


def _totals(fit: DataFrame, partial, size: int) -> np.ndarray:
    """Element-wise sums of ``partial(x)`` over the blocks of the fit list:
    added inside each task, then by Spark over the tasks."""
    kind = "long" if partial is _entry_sums else "double"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if len(b["x"]):
                got = partial(_matrix(b)).ravel()
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["part"])

    parts = fit.select("x").mapInArrow(freed(add), f"part array<{kind}>")
    sums = parts.select(F.posexplode("part").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
    out = np.zeros(size, np.int64 if kind == "long" else float)
    for row in sums.collect():
        out[row["at"]] = row["v"]
    return out


def _entry_sums(x: np.ndarray) -> np.ndarray:
    return x.sum(axis=0)


@dataclass
class Whitening:
    """Fitted state: d numbers, d x k components, k eigenvalues."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, from the exact difference n*x - S."""
        if self.n * float(np.abs(x).max(initial=0)) + float(np.abs(self.sums).max(initial=0)) < 2.0 ** 62:
            return (self.n * x - self.sums) / self.n
        return x - self.sums / self.n

    def live(self) -> np.ndarray:
        """Which components have variance."""
        return self.values > len(self.sums) * EPS * self.trace

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates (columns without variance are nan)."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.live(), 1 / np.sqrt(np.maximum(self.values, 0)), np.nan)
        return (self.centred(x) @ self.vectors) * scale

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Exact sum over dimensions of (n*x - S)^2."""
        rough = self.n * np.abs(x).astype(float) + np.abs(self.sums)
        fits = (rough * rough).sum(axis=1) < 2.0 ** 62
        out = np.zeros(len(x), np.int64)
        exact = self.n * x[fits] - self.sums
        out[fits] = (exact * exact).sum(axis=1)
        if fits.all():
            return pa.array(out)
        slow = [int(v) for v in out]
        for i in np.flatnonzero(~fits):
            total = sum((self.n * int(a) - int(s)) ** 2 for a, s in zip(x[i], self.sums))
            slow[i] = total if total < 2 ** 63 else None
        return pa.array(slow, pa.int64())


def fit_whitening(vectors: DataFrame, n_components: int = 4) -> Whitening | None:
    """Fit on the distinct x vectors of ``vectors(vec_id, x)``; None if there
    is none."""
    fit = materialize(vectors.select("x").distinct(), "whitening-fit")
    lengths = fit.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.where("d > 0").orderBy(F.desc("n"), F.desc("d")).first()
    if top is None:
        return None
    d, n = top["d"], top["n"]
    fit = fit.where(F.size("x") == d)
    state = Whitening(n, _totals(fit, _entry_sums, d), np.zeros(0), np.zeros((d, 0)), 0.0)

    def products(x: np.ndarray) -> np.ndarray:
        c = state.centred(x)
        return c.T @ c

    cov = _totals(fit, products, d * d).reshape(d, d) / n
    state.trace = float(np.trace(cov))
    state.values, state.vectors = components(cov, n_components)
    live = state.live()
    k = int(live.sum())
    if k:
        def whitened_products(x: np.ndarray) -> np.ndarray:
            y = state.apply(x)[:, live]  # centred already
            return y.T @ y

        white = _totals(fit, whitened_products, k * k).reshape(k, k) / n
        state.identity_error = float(np.abs(white - np.eye(k)).max())
    return state


def whiten(rows: DataFrame, n_components: int = 4, vector: str = "embedding") -> DataFrame:
    """One row per remaining row and component: vec_id, component (from 1),
    n, deviation, whitened, explained, identity_error."""
    vectors = quantised(rows, vector)
    state = fit_whitening(vectors, n_components)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double,"
              " explained double, identity_error double")
    spark = rows.sparkSession
    if state is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(state)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        k = len(s.values)
        explained = s.values / s.trace if s.trace > 0 else np.full(k, np.nan)
        for b in batches:
            rows = len(b["x"])
            if not rows:
                continue
            x = _matrix(b)
            at = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays([
                b["vec_id"].take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, s.n, np.int64)), s.deviation(x).take(at),
                pa.array(s.apply(x).ravel(), from_pandas=True),
                pa.array(np.tile(explained, rows), from_pandas=True),
                pa.array([s.identity_error] * (rows * k), pa.float64()),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.where(F.size("x") == len(state.sums)).mapInArrow(freed(apply), schema)
