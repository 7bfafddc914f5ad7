"""Embedding whitening by Chebyshev-filtered subspace iteration.

The covariance V is never formed. A pass over the stored vectors multiplies it with a block Q of
some columns: each task adds up its rows' centred C'CQ, Spark adds up the tasks. A polynomial of
such passes, by the Chebyshev recurrence, keeps the wanted end of the spectrum large and everything
inside the interval of unwanted eigenvalues small. QR and a Rayleigh-Ritz step in the block follow,
until the residuals ||Vq - eq|| certify the wanted pairs. The driver holds matrices of one dimension
by the block, never rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, cut_lineage

EPS = float(np.finfo(float).eps)
#: Entries of which 64 times the size is at least this are no measurements; such rows count as broken.
MOST = 1 << 40
#: Rows that a task multiplies or writes at a time.
ROWS = 4096


@dataclass(frozen=True)
class WhitenSettings:
    """``components`` wanted; ``guard`` more columns in the block; ``degree`` of the polynomial;
    ``bound_steps`` of the Lanczos run that finds the lower end of the spectrum; ``tolerance`` of
    the residuals in units of the largest eigenvalue; ``cycles`` after which an uncertified run
    fails.
    """

    components: int = 32
    guard: int = 16
    degree: int = 10
    bound_steps: int = 8
    tolerance: float = 1e-13
    cycles: int = 60
    scale: int = 64
    offset: int = 1_000_000
    seed: int = 11


def scaled(rows: DataFrame, key: str, vector: str, settings: WhitenSettings) -> DataFrame:
    """(key, x): x = floor(scale * entry) + offset of the usable vectors, as packed 64-bit numbers."""
    s = settings
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for i, values in enumerate(batch.column("v")):
                if not values.is_valid or values.values.null_count:
                    continue
                v = np.asarray(values.values, float) * s.scale
                if len(v) and np.isfinite(v).all() and abs(v).max() < MOST:
                    ids.append(i)
                    found.append((np.floor(v).astype(np.int64) + s.offset).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("k").take(pa.array(ids, pa.int64())), pa.array(found, pa.binary())], ["k", "x"]
            )

    typed = rows.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v"))
    return typed.mapInArrow(run, f"k {kind}, x binary")


def matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their vectors as whole numbers, at most ``ROWS`` rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            x = Texts(part.column("x")).data
            yield part, np.frombuffer(x.tobytes(), np.int64).reshape(-1, d)


def added(parts: DataFrame, rows: int, columns: int) -> np.ndarray:
    """The sum of the matrices whose rows (i, values) all tasks give."""
    sums = [F.sum(F.get("values", F.lit(j))).alias(f"c{j}") for j in range(columns)]
    out = np.zeros((rows, columns))
    for row in parts.groupBy("i").agg(*sums).collect():
        out[row["i"]] = row[1:]
    return out


class Covariance:
    """Centred vectors as an operator; every product is one pass over the stored rows."""

    def __init__(self, stored: DataFrame, d: int):
        self.stored, self.d, self.passes = stored, d, 0

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums = 0, [0] * d
            for _, x in matrices(batches, d):
                n += len(x)
                sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), pa.array(map(str, sums))],
                ["i", "n", "s"],
            )

        totals = stored.mapInArrow(run, "i int, n long, s string")
        whole = F.col("s").cast("decimal(38,0)")
        found = totals.groupBy("i").agg(F.sum("n").alias("n"), F.sum(whole).alias("s")).collect()
        self.n = found[0]["n"]
        self.sums = [int(r["s"]) for r in sorted(found, key=lambda r: r["i"])]
        #: The mean is base + part / n with whole numbers, so that centring loses no digit.
        self.base = np.array([s // self.n for s in self.sums], np.int64)
        self.part = [s % self.n for s in self.sums]
        self.shift = np.array([p / self.n for p in self.part])

    def summed(self, product, rows: int, columns: int) -> np.ndarray:
        """The sum over all rows of ``product`` (centred rows -> matrix), divided by their number."""
        d, base, shift = self.d, self.base, self.shift
        self.passes += 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((rows, columns))
            for _, x in matrices(batches, d):
                total += product((x - base) - shift)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(rows), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "values"]
            )

        parts = self.stored.mapInArrow(run, "i int, values array<double>")
        return added(parts, rows, columns) / self.n

    def times(self, q: np.ndarray) -> np.ndarray:
        return self.summed(lambda c: c.T @ (c @ q), self.d, q.shape[1])

    def trace(self) -> float:
        return float(self.summed(lambda c: np.array([[(c * c).sum()]]), 1, 1)[0, 0])


def lowest(v: Covariance, steps: int, start: np.random.Generator) -> float:
    """A value that the smallest eigenvalue is not far below, by Lanczos steps from a random vector."""
    q = start.standard_normal(v.d)
    basis, diagonal, beside = [q / np.linalg.norm(q)], [], []
    for _ in range(min(steps, v.d)):
        w = v.times(basis[-1][:, None])[:, 0]
        diagonal.append(float(w @ basis[-1]))
        whole = np.stack(basis, 1)
        for _ in range(2):
            w = w - whole @ (whole.T @ w)
        beside.append(float(np.linalg.norm(w)))
        if beside[-1] <= EPS * max(map(abs, diagonal)):
            break
        basis.append(w / beside[-1])
    k = len(diagonal)
    ritz, vectors = np.linalg.eigh(np.diag(diagonal) + np.diag(beside[: k - 1], 1) + np.diag(beside[: k - 1], -1))
    return max(0.0, float(ritz[0] - abs(beside[k - 1] * vectors[-1, 0])))


def filtered(v: Covariance, q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V times q that is small on [low, high] and 1 or so at ``top``."""
    half, middle = (high - low) / 2, (high + low) / 2
    ratio = first = half / (middle - top)
    before, now = q, (v.times(q) - middle * q) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - ratio)
        before, now = now, 2 * (following / half) * (v.times(now) - middle * now) - ratio * following * before
        ratio = following
    return now


def eigenpairs(v: Covariance, settings: WhitenSettings) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns; eigenvalues that are zero
    to working precision are left out.

    Certified: every residual is at most ``tolerance`` times the largest eigenvalue, or, where
    rounding stops it before, does not fall any more and is below the square root of that.
    """
    s = settings
    wanted, block = min(s.components, v.d), min(v.d, s.components + s.guard)
    start = np.random.default_rng(s.seed)
    q = np.linalg.qr(start.standard_normal((v.d, block)))[0]
    low = lowest(v, s.bound_steps, start) if block < v.d else 0.0
    worst = np.inf
    for _ in range(s.cycles):
        image = v.times(q)
        inner = q.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        top = float(values[0])
        if top <= 0:
            return values[:0], q[:, :0]
        residual = np.linalg.norm(image - q * values, axis=0)[:wanted].max() / top
        stuck = residual > worst / 2 and residual < s.tolerance**0.5
        if residual <= s.tolerance or stuck or block == v.d:
            kept = values[:wanted] > v.d * EPS * top
            return values[:wanted][kept], q[:, :wanted][:, kept]
        worst = residual
        high = float(values[-1])
        if high <= low:
            low = 0.0
        if high <= v.d * EPS * top:
            # All the rest of the spectrum is zero: the plain power step removes it.
            q = np.linalg.qr(image)[0]
        else:
            q = np.linalg.qr(filtered(v, q, low, high, top, s.degree))[0]
    raise RuntimeError(f"no certified eigenvectors after {s.cycles} cycles, residual {worst:.1e}")


def deviations(centred: np.ndarray, n: int, part: list[int]) -> pa.Array:
    """For rows x - base, the exact sums of (n * (x - base) - part) ** 2; NULL beyond 64 bits."""
    square = sum(p * p for p in part)
    if centred.size and float(abs(centred).max() + 1) ** 2 * n * centred.shape[1] < 2**60:
        own = (centred * centred).sum(axis=1).tolist()
        cross = (centred * np.array(part, np.int64)).sum(axis=1).tolist()
    else:
        whole = centred.astype(object)
        own, cross = (whole * whole).sum(axis=1), (whole * np.array(part, object)).sum(axis=1)
    exact = [n * n * int(a) - 2 * n * int(b) + square for a, b in zip(own, cross)]
    return pa.array([x if x < 1 << 63 else None for x in exact], pa.int64())


def whiten(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", settings: WhitenSettings = WhitenSettings()
) -> DataFrame:
    """One row per usable vector and component: vec_id, component (from 1 by falling eigenvalue), n,
    deviation, whitened, explained, identity_error.

    Each entry c becomes x = floor(64 * c) + 1000000. n counts the vectors, deviation is the exact
    sum of (n * x - S) ** 2 with S the sums of the dimensions (NULL where it passes 64 bits),
    whitened is x - S / n projected on the unit eigenvector of the covariance of x, over the root of
    its eigenvalue; explained is the eigenvalue's share of the trace. identity_error is the largest
    entry of the covariance of the whitened values minus the identity, measured on all rows.

    Left out are NULL and empty vectors, vectors with an entry that is NULL, not finite or beyond
    2 ** 34, and vectors of another length than most have (the shorter length of two as frequent).
    Components with an eigenvalue of zero are left out; so a table of one vector, or of equal ones,
    gives no rows, as does an empty table. Rows with a NULL or a repeated key are rows like others;
    other columns are ignored.
    """
    s = settings
    kind = rows.schema[key].dataType.simpleString()
    columns = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    form = f"vec_id {kind}, {columns}"
    stored = cut_lineage(scaled(rows, key, vector, s))
    size = F.length("x").alias("size")
    common = stored.groupBy(size).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return rows.sparkSession.createDataFrame([], form)
    d = common["size"] // 8
    stored = stored.where(F.length("x") == common["size"])
    v = Covariance(stored, d)
    values, vectors = eigenpairs(v, s)
    k = len(values)
    if not k:
        return rows.sparkSession.createDataFrame([], form)
    project = vectors / np.sqrt(values)
    explained = values / v.trace()
    # The mean of the whitened values is that of the centred ones, which is zero.
    inner = v.summed(lambda c: (c @ project).T @ (c @ project), k, k)
    error = float(abs(inner - np.eye(k)).max())
    n, base, part, shift = v.n, v.base, v.part, v.shift

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in matrices(batches, d):
            m, whole = len(x), x - base
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n)),
                    deviations(whole, n, part).take(pa.array(each)),
                    pa.array(((whole - shift) @ project).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                [c.split()[0] for c in form.split(", ")],
            )

    return stored.mapInArrow(run, form)
