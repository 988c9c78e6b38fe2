"""Whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V = XᵀX / n of centred vectors X are
found without V: a block Q of directions is multiplied by V in passes over the
rows, each task adding up its part of Xᵀ(XQ). A filter is a polynomial in V,
applied by the three-term recurrence of the Chebyshev polynomials on the
interval [0, b] that holds the unwanted spectrum, one pass a degree: directions
inside stay below one, those above grow fastest of all polynomials of the
degree. Then QR makes the block orthonormal, one pass gives VQ, and
Rayleigh-Ritz the eigenpairs within the block; its least Ritz value is the next
b. The loop ends when the residuals |Vu - eu| of the wanted pairs are certified
below ``TOL`` of the largest eigenvalue, or at the rounding of a pass (they
stopped falling and are below ``FLOOR``). The block is ``GUARD`` directions
wider than asked, so the wanted pairs converge at the gap to the block's end;
where that gap is too small for a tenfold gain a round, the block is doubled.

A component c counts as the integer x = floor(1024 c) + 100000; sums S and
deviations n x - S are exact integers, so centring rounds once. Eigenvalues
below ``RANK`` of the largest are zero: such components are left out, as there is
nothing to divide by (one vector, or equal ones, give no row). With equal
eigenvalues any basis of their space is right.

Rows whose vector is null or holds null or non-finite entries take no part, nor
do vectors of another length than most (ties: the shorter) or empty ones, nor
entries whose integer is beyond +-2**52. Rows are kept as they are: repeated
ids, and null ones, are rows of their own. ``deviation`` is null where it does
not fit a long. An empty table gives an empty result. Columns other than the id
and the vector are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Shared, source
from .vectors import binary, flat, matrix, most_common_size, sound

K = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = 2 ** 52
GUARD = 32
DEGREE = 10
#: Residuals, relative to the largest eigenvalue, that end the loop; at or below the second one a loop that no
#: longer gains is at the rounding of its passes.
TOL, FLOOR = 1e-14, 1e-9
RANK = 1e-11


def _integers(batches):
    for b in batches:
        x = np.floor(flat(b.column(1)) * SCALE) + SHIFT
        fits = (np.abs(x) <= LARGEST).all(1) if len(x) else np.zeros(0, bool)
        yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(fits)), binary(x[fits].astype(np.int64).reshape(int(fits.sum()), -1))], ["id", "vec"])


class Centred:
    """Deviations n x - S of integer rows: exact in 64 bits where they fit, else in Python's integers."""

    def __init__(self, n: int, sums: list[int], low: list[int], high: list[int]):
        self.n, self.dim = n, len(sums)
        far = max(max(abs(n * h - s), abs(n * lo - s)) for s, lo, h in zip(sums, low, high))
        self.kind = np.int64 if n * max(map(abs, [*low, *high, 1])) < 2 ** 62 else object
        self.fits = far * far * self.dim < 2 ** 63
        self.sums = np.array(sums, self.kind)

    def exact(self, vec) -> np.ndarray:
        return matrix(vec, np.int64).astype(self.kind) * self.n - self.sums

    def rows(self, vec) -> np.ndarray:
        return self.exact(vec).astype(np.float64) / self.n

    def deviations(self, vec) -> list[int | None]:
        a = self.exact(vec)
        if self.fits and self.kind is np.int64:
            return np.einsum("ij,ij->i", a, a).tolist()
        sums = [sum(x * x for x in row) for row in a.tolist()]
        return [s if s < 2 ** 63 else None for s in sums]


def _pass(on_all, q: np.ndarray):
    """Of a task: its part of Xᵀ(XQ), as (cell, value) rows."""
    def run(batches):
        total = np.zeros(q.shape)
        for b in batches:
            if b.num_rows:
                x = on_all.value.rows(b.column(0))
                total += x.T @ (x @ q)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(q.size, dtype=np.int32)), pa.array(total.ravel())], ["cell", "value"])
    return run


def chebyshev(times_v, q: np.ndarray, degree: int, b: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of ``degree`` of V on [0, b], scaled to about one at ``top``, times ``q``."""
    half = b / 2
    s1 = half / (half - top)
    s, before, now = s1, q, (times_v(q) - half * q) * (s1 / half)
    for _ in range(degree - 1):
        nxt = 1 / (2 / s1 - s)
        before, now = now, (times_v(now) - half * now) * (2 * nxt / half) - s * nxt * before
        s = nxt
    return now


def leading_eigenpairs(times_v, dim: int, k: int, degree: int = DEGREE, guard: int = GUARD, seed: int = 11) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(eigenvalues, vectors as columns, residual of each round) of the symmetric, non-negative V that
    ``times_v`` multiplies by."""
    rng, history = np.random.default_rng(seed), []
    q = np.linalg.qr(rng.normal(size=(dim, min(dim, k + guard))))[0]
    while True:
        vq = times_v(q)
        small = q.T @ vq
        e, u = np.linalg.eigh((small + small.T) / 2)
        e, u = e[::-1], u[:, ::-1]
        q, vq = q @ u, vq @ u
        top = float(e[0])
        if top <= 0:
            return e[:k], q[:, :k], history
        wanted = e[:k] > RANK * top
        residual = np.linalg.norm(vq - q * e, axis=0)[:k][wanted]
        history.append(float(residual.max() / top))
        slow = len(history) > 2 and history[-1] > min(history[:-1]) / 10
        if history[-1] <= TOL or q.shape[1] == dim or slow and history[-1] <= FLOOR:
            return e[:k], q[:, :k], history
        low = max(float(e[-1]), RANK * top)
        if slow:
            q = np.hstack([q, rng.normal(size=(dim, min(q.shape[1], dim - q.shape[1])))])
        q = np.linalg.qr(chebyshev(times_v, q, degree, low, top))[0]


def _whitened(on_all, u: np.ndarray, root: np.ndarray):
    def run(batches):
        for b in batches:
            if b.num_rows:
                w = (on_all.value.rows(b.column(1)) @ u) / root
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(on_all.value.deviations(b.column(1)), pa.int64()), binary(w)], ["id", "deviation", "w"])
    return run


def _second_moments(k: int):
    """Of a task: sums of w and of w wᵀ, as (cell, value) rows."""
    def run(batches):
        total = np.zeros((k + 1, k))
        for b in batches:
            if b.num_rows:
                w = matrix(b.column(0), np.float64)
                total[0] += w.sum(0)
                total[1:] += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["cell", "value"])
    return run


def _summed(parts: DataFrame, shape: tuple) -> np.ndarray:
    """Cells added over all tasks: as many rows as ``shape`` has cells come to the driver."""
    out = np.zeros(int(np.prod(shape)))
    for cell, value in parts.groupBy("cell").agg(F.sum("value")).collect():
        out[cell] = value
    return out.reshape(shape)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, report: dict | None = None) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every vector and component;
    ``report`` gets the residuals of the rounds and the number of passes."""
    spark = vectors.sparkSession
    shared = Shared(spark, "whitening")
    empty = spark.createDataFrame([], f"{id_col} long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).where(sound("v") & (F.size("v") > 0))
    dim = most_common_size(src, "v")
    if dim is None:
        return empty
    src = src.where(F.size("v") == dim).select("id", F.col("v").cast("array<double>"))
    table = shared.put(src.mapInArrow(_integers, "id long, vec binary"), "integers")

    def column_sums(batches):
        n, s, low, high = 0, np.zeros(dim, object), [LARGEST] * dim, [-LARGEST] * dim
        for b in batches:
            if b.num_rows:
                x = matrix(b.column(0), np.int64)
                n, s = n + len(x), s + x.sum(0).astype(object)  # a batch's sum fits: 2**52 times its rows
                low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim)), pa.array([str(v) for v in s]), pa.array(np.array(low, np.int64)), pa.array(np.array(high, np.int64)),
                                              pa.array([n] * dim)], ["d", "s", "low", "high", "n"])

    sums = table.select("vec").mapInArrow(column_sums, "d long, s string, low long, high long, n long").groupBy("d").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).orderBy("d").collect()
    if not sums:
        return empty
    n = sums[0]["n"]
    centred = Centred(n, [int(r["s"]) for r in sums], [r["low"] for r in sums], [r["high"] for r in sums])
    on_all = spark.sparkContext.broadcast(centred)
    vecs, passes = table.select("vec"), [0]

    def times_v(q: np.ndarray) -> np.ndarray:
        passes[0] += 1
        return _summed(vecs.mapInArrow(_pass(on_all, q), "cell int, value double"), q.shape) / n

    e, u, history = leading_eigenpairs(times_v, dim, min(k, dim))
    if report is not None:
        report.update(residuals=history, passes=passes[0])
    kept = e > RANK * max(float(e[0]), 0.0)
    e, u = e[kept], u[:, kept]
    if not len(e):
        return empty
    out = shared.put(table.mapInArrow(_whitened(on_all, u, np.sqrt(e)), "id long, deviation long, w binary"), "whitened")
    m = _summed(out.select("w").mapInArrow(_second_moments(len(e)), "cell int, value double"), (len(e) + 1, len(e))) / n
    identity_error = float(np.abs(m[1:] - np.outer(m[0], m[0]) - np.eye(len(e))).max())

    def squares(batches):
        total = np.zeros(dim)
        for b in batches:
            if b.num_rows:
                total += (on_all.value.rows(b.column(0)) ** 2).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(total)], ["cell", "value"])

    # the variances of all dimensions, centred before they are squared
    trace = float(_summed(vecs.mapInArrow(squares, "cell int, value double"), (dim,)).sum() / n)
    shares, names = (e / trace).tolist(), empty.columns

    def longer(batches):
        for b in batches:
            if b.num_rows:
                w = matrix(b.column(2), np.float64)
                rows = pa.array(np.repeat(np.arange(len(w)), len(shares)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), pa.array(np.tile(np.arange(1, len(shares) + 1, dtype=np.int32), len(w))), pa.array(np.full(w.size, n)), b.column(1).take(rows),
                     pa.array(w.ravel()), pa.array(np.tile(shares, len(w))), pa.array(np.full(w.size, identity_error))], names)
    return out.mapInArrow(longer, empty.schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings``, whitened on their 8 leading components."""
    return whiten(source(spark, sf_dir, "embeddings"))
