"""Whitening of embeddings on their leading principal components.

The components are eigenvectors of the covariance V of the distinct vectors
(the fit list), found by Chebyshev-filtered subspace iteration. V is never
formed: one pass sends a block Q of a few columns to the tasks, each task
returns the sum of c (c'Q) over its centred vectors c, and the driver adds up
these small blocks. A round damps the spectrum below the block's smallest
Ritz value by a Chebyshev polynomial of V (a three-term recurrence of passes),
makes the block orthonormal (QR), and solves the projected problem
(Rayleigh-Ritz). Rounds go on until every wanted vector's residual
|Vq - eq| is at most ``TOLERANCE`` of the largest eigenvalue; a fit that does
not get there in ``max_rounds`` raises ``NotCertified``.

Vectors are made whole numbers x = floor(scale * c), so sums and deviations
are exact; a vector is centred as (n x - S) / n, where n is the size of the
fit list and S its sum, and only then multiplied.

The fit list is one shuffle of distinct vectors (a vector that a third of all
rows share is one row of each task), written once as binary blocks into the
shared folder; passes read the blocks, so a lost executor costs one pass's
tasks. To the driver come block sums only: dimension x block numbers a task,
added up in a second step beyond ``FAN_IN`` tasks.

Defined cases: rows whose vector is null, holds a null or non-finite entry, or
one whose scaled value is no 64-bit whole number are left out, and so are
vectors of another length than most distinct vectors have (ties: the greater
length); ids may be null; each repeated row is returned but fitted once; a
component without variance (eigenvalue at most 1e-12 of the trace) is not
returned, so that one distinct vector, or an empty table, gives no rows; a
deviation beyond 64 bits is null.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .arrow_text import mix64

SCALE = 256
COMPONENTS = 4
#: Columns of the block beyond the wanted ones, and degree of the filter.
GUARD = 28
DEGREE = 10
TOLERANCE = 1e-14
MAX_ROUNDS = 60
#: Partial sums that the driver takes from one pass; more are added up in tasks first.
FAN_IN = 256
#: Bytes of one stored block.
BLOCK_BYTES = 1 << 20
_ZERO = 1e-12


class NotCertified(RuntimeError):
    """The residuals did not reach the tolerance."""


def whole_vectors(rows: DataFrame, vector: str, scale: int = SCALE) -> DataFrame:
    """Rows with a usable vector, and ``__x``: its entries as whole numbers."""
    limit = float(1 << 62)
    scaled = F.transform(F.col(vector), lambda c: F.lit(float(scale)) * c.cast("double"))
    usable = F.forall(scaled, lambda c: F.coalesce(F.abs(c) < limit, F.lit(False)))  # a NaN is greater than all
    return rows.where(usable & (F.size(vector) > 0)).withColumn(
        "__x", F.transform(scaled, lambda c: F.floor(c).cast("long")))


def _matrix(column) -> tuple[np.ndarray, np.ndarray]:
    """(entries, offsets) of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0]


def _pack(batches):
    """Blocks (dims, rows, 64-bit entries) of vectors of one length."""
    for b in batches:
        flat, offsets = _matrix(b.column(0))
        size = np.diff(offsets)
        for d in np.unique(size):
            at = np.flatnonzero(size == d)
            step = max(1, BLOCK_BYTES // (8 * int(d)))
            for lo in range(0, len(at), step):
                part = at[lo:lo + step]
                x = flat[offsets[part][:, None] + np.arange(d)]
                yield pa.RecordBatch.from_arrays([pa.array([int(d)], pa.int64()), pa.array([len(part)], pa.int64()),
                                                  pa.array([x.astype("<i8").tobytes()], pa.binary())],
                                                 ["dims", "rows", "x"])


class _FitList:
    """The distinct vectors of one length as stored blocks, with their number and sum."""

    def __init__(self, blocks: DataFrame, dims: int, n: int):
        self.blocks, self.dims, self.n = blocks.where(F.col("dims") == dims).select("x"), dims, n
        # sums of the high and low halves stay within 64 bits in any task
        def halves(x):
            return np.concatenate([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)])
        parts = self._partials(halves, "<i8")
        self.sum = [sum(int(p[c]) * (1 << 32) + int(p[dims + c]) for p in parts) for c in range(dims)]
        self.centre = centring(n, self.sum)

    def _partials(self, of_block, kind: str) -> list[np.ndarray]:
        """Sums of ``of_block`` over the blocks of each task, at most FAN_IN of them."""
        dims = self.dims

        def work(batches):
            total = None
            for b in batches:
                for cell in b.column(0):
                    part = of_block(np.frombuffer(cell.as_buffer(), "<i8").reshape(-1, dims))
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.astype(kind).tobytes()], pa.binary())], ["part"])

        def add(batches):
            total = None
            for b in batches:
                for cell in b.column(0):
                    part = np.frombuffer(cell.as_buffer(), kind)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

        found = self.blocks.mapInArrow(work, "part binary")
        tasks = self.blocks.rdd.getNumPartitions()
        if tasks > FAN_IN:
            found = found.repartition(max(FAN_IN, math.isqrt(tasks))).mapInArrow(add, "part binary")
        return [np.frombuffer(bytes(r[0]), kind) for r in found.collect()]

    def total(self, of_centred, shape: tuple) -> np.ndarray:
        """Sum over the fit list of a function of blocks of centred vectors."""
        centre = self.centre
        parts = self._partials(lambda x: of_centred(centre(x)).ravel(), "<f8")
        return np.sum(np.sort(np.array(parts), axis=0), axis=0).reshape(shape)  # whatever the order of the tasks

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q in one pass."""
        return self.total(lambda c: c.T @ (c @ q), q.shape) / self.n


def centring(n: int, total: list[int]):
    """x -> x - S / n as doubles, from exact whole numbers where these fit 64 bits."""
    far = max(map(abs, total), default=0)
    whole = np.array([t if far < 1 << 62 else 0 for t in total], np.int64)
    mean = np.array([t / n for t in total])

    def centre(x: np.ndarray) -> np.ndarray:
        if far < 1 << 62 and (len(x) == 0 or int(np.abs(x).max()) * n < 1 << 62):
            return (x * n - whole) / n
        return x - mean
    return centre


@dataclass
class Whitening:
    """A fitted whitening; ``vectors`` holds one component a column."""

    dims: int
    n: int
    total: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    rounds: int = 0
    passes: int = 0
    residual: float = 0.0
    identity_error: float = 0.0


def _start(dims: int, width: int) -> np.ndarray:
    """A fixed dense block."""
    bits = mix64(np.arange(1, dims * width + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return ((bits >> np.uint64(11)).astype(np.float64) / (1 << 53) - 0.5).reshape(dims, width)


def fit(rows: DataFrame, *, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
        degree: int = DEGREE, guard: int = GUARD, tolerance: float = TOLERANCE,
        max_rounds: int = MAX_ROUNDS) -> Whitening | None:
    """Fit on the distinct vectors; None if no vector is usable."""
    spark = rows.sparkSession
    path = scratch_path(spark, "fit-list")
    whole_vectors(rows.select(F.col(vector).alias("v")), "v", scale).select("__x").dropDuplicates().mapInArrow(
        _pack, "dims long, rows long, x binary").write.parquet(path)
    blocks = spark.read.parquet(path)
    lengths = blocks.groupBy("dims").agg(F.sum("rows").alias("n")).orderBy(F.desc("n"), F.desc("dims")).head(1)
    if not lengths:
        return None
    dims, n = lengths[0]
    data = _FitList(blocks, dims, n)
    trace = float(data.total(lambda c: (c * c).sum(0), (dims,)).sum()) / n
    out = Whitening(dims, n, data.sum, np.zeros(0), np.zeros((dims, 0)), trace)
    if trace == 0:
        return out
    wanted, width = min(components, dims), min(components + guard, dims)
    q = np.linalg.qr(_start(dims, width))[0]
    while True:
        w = data.times(q)
        h = q.T @ w
        e, u = np.linalg.eigh((h + h.T) / 2)
        e, u = e[::-1], u[:, ::-1]
        q, w = q @ u, w @ u
        out.passes += 1
        out.residual = float(np.linalg.norm(w[:, :wanted] - q[:, :wanted] * e[:wanted], axis=0).max() / e[0])
        if out.residual <= tolerance * math.sqrt(dims):
            break
        if out.rounds == max_rounds:
            raise NotCertified(f"residual {out.residual:.3g} of the largest eigenvalue after {out.rounds} rounds")
        out.rounds += 1
        q = _filtered(data, q, w, e, degree, out)
        # twice is enough for orthogonality to the last digit
        q = np.linalg.qr(np.linalg.qr(q / np.linalg.norm(q, axis=0))[0])[0]
    keep = [i for i in range(wanted) if e[i] > _ZERO * trace]
    out.values, out.vectors = e[keep], q[:, keep]
    k, by = len(keep), out.vectors / np.sqrt(out.values)

    def moments(c):
        y = c @ by
        return np.vstack([y.sum(0), y.T @ y])
    found = data.total(moments, (k + 1, k)) / n
    out.passes += 1
    out.identity_error = float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(k)).max()) if k else 0.0
    return out


def _filtered(data: _FitList, q, w, e, degree: int, out: Whitening) -> np.ndarray:
    """p(V) q, where p is small on [0, e[-1]] and grows fast above it; w is V q.

    The recurrence is scaled by the polynomial's value at e[0], so nothing overflows.
    """
    half = max(e[-1], 1e-300 + 1e-14 * e[0]) / 2
    sigma = first = half / (e[0] - half)
    y = (w - half * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        q, y = y, (data.times(y) - half * y) * (2 * after / half) - sigma * after * q
        sigma = after
        out.passes += 1
    return y


def transform(rows: DataFrame, model: Whitening | None, *, id_col: str = "vec_id", vector: str = "embedding",
              scale: int = SCALE) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every usable row and component."""
    kind = rows.schema[id_col].dataType.simpleString()
    schema = (f"{id_col} {kind}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    k, dims, n = len(model.values), model.dims, model.n
    by = model.vectors / np.sqrt(model.values)
    centre = centring(n, model.total)
    # exact modulo 2**64, and told apart by the double where it does not fit
    count, total = np.uint64(n), np.array([t % (1 << 64) for t in model.total], np.uint64)
    explained, error = model.values / model.trace, model.identity_error

    def work(batches):
        for b in batches:
            flat, _ = _matrix(b.column(1))
            x = flat.reshape(-1, dims)
            c = centre(x)
            d = x.astype(np.uint64) * count - total
            exact = (d * d).sum(1, dtype=np.uint64).astype(np.int64)
            fits = ((c * n) ** 2).sum(1) < 9.2233e18
            y = c @ by
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                 pa.array(np.repeat(exact, k), mask=np.repeat(~fits, k)), pa.array(y.ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    usable = whole_vectors(rows.select(F.col(id_col).alias("id"), F.col(vector).alias("v")), "v", scale)
    return usable.where(F.size("__x") == dims).select("id", "__x").mapInArrow(work, schema)
