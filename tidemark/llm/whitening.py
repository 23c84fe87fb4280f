"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Every entry ``c`` becomes the integer ``floor(64 * c) + 1000000``. The components are
the leading eigenvectors of the covariance of the distinct integer vectors, found without
a covariance matrix: a block of ``WIDTH`` times as many directions as wanted goes
through a Chebyshev polynomial of the covariance, whose recurrence needs one product
``X'(XQ)`` of the centred vectors per step. Each product is one Spark job over blocks of
vectors; tasks return sums of the size of ``Q``. The driver adds them; those of more than
``FAN_IN`` tasks meet in groups of that many first. The polynomial is bounded on the unwanted spectrum and grows
fast above it; a few Lanczos steps say where that spectrum begins. A wrong guess shows in the
values of the block, and the spectrum is then taken to begin at 0. QR and a Rayleigh-Ritz step follow, until the residual of every
wanted pair is at most ``TOLERANCE`` times the largest eigenvalue, or has stopped falling
below ``SETTLED`` (the limit of double precision); an iteration that does neither within
``ROUNDS`` rounds raises an error.

The distinct vectors are stored as the least width of bytes that holds them, so a pass
reads little. Sums ``S`` and counts are exact. ``deviation`` is exact; it is null where it
does not fit into a long.

Rows whose vector is null or empty, or holds a null, a component that is not finite or
one whose 64-fold exceeds 2^53 (which has no exact integer), take no part. Neither do
vectors of another length than most distinct ones have (of equally frequent lengths the
longest counts): no covariance between lengths is defined. Repeated rows each get their
rows, and count once in the fit; so do rows with a null id. Components without variance
cannot be whitened and are left out, so a table of fewer distinct vectors than components, or of one,
gives fewer or no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

SCALE, OFFSET = 64, 1_000_000
#: Directions iterated per component wanted; steps that look for the least eigenvalue.
WIDTH, LANCZOS = 3, 8
#: Residual against the largest eigenvalue at which a pair is certified.
TOLERANCE, SETTLED = 1e-13, 1e-10
ROUNDS, DEGREE = 200, 24
#: Vectors and bytes of a stored block.
ROWS, BYTES = 4096, 4 << 20
#: Partial sums added in one place.
FAN_IN = 128
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def quantised(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, q)`` for each length of vector in an Arrow column: places of the usable rows, ``floor(64 * c)``."""
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become nan
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.floor(SCALE * values)
        bad = np.concatenate([[0], np.cumsum(~(np.abs(whole) < 2.0**53))])
    lengths = np.diff(ends)
    fine = column.is_valid().to_numpy(zero_copy_only=False) & (bad[ends[1:]] == bad[ends[:-1]]) & (lengths > 0)
    for length in np.unique(lengths[fine]):
        rows = np.flatnonzero(fine & (lengths == length))
        yield rows, whole[ends[rows][:, None] + np.arange(length)].astype(np.int64)


def _codes(q: np.ndarray) -> list[bytes]:
    """Each vector as one byte for its width and its entries in as few bytes each."""
    most = np.maximum(q.max(axis=1), -(q.min(axis=1) + 1))
    widths = np.select([most < 1 << 7, most < 1 << 15, most < 1 << 31], [1, 2, 4], 8)
    out: list[bytes] = [b""] * len(q)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        data, size, mark = q[rows].astype(f"<i{width}").tobytes(), q.shape[1] * width, bytes([width])
        for k, row in enumerate(rows):
            out[row] = mark + data[k * size : (k + 1) * size]
    return out


def _block(codes: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(c, f"<i{c[0]}", offset=1) for c in codes])


def blocks_of(vectors: DataFrame, column: str) -> DataFrame:
    """``(length, rows, width, data)``: the distinct integer vectors in blocks of one length."""

    def coded(batches):
        for batch in batches:
            for rows, q in quantised(batch.column(0)):
                codes = _codes(q)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q.shape[1]] * len(rows), pa.int32()), pa.array(codes, pa.binary())], names=["length", "code"]
                )

    def gathered(batches):
        held: dict[int, list[bytes]] = {}

        def made(length: int) -> pa.RecordBatch:
            codes = held.pop(length)
            width = max(c[0] for c in codes)
            data = _block(codes).astype(f"<i{width}").tobytes()
            values = [length], [len(codes)], [width], [data]
            kinds = pa.int32(), pa.int32(), pa.int32(), pa.binary()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=["length", "rows", "width", "data"]
            )

        for length, code in common.rows(batches, "length", "code"):
            own = held.setdefault(length, [])
            own.append(code)
            if len(own) >= ROWS or len(own) * length * 8 >= BYTES:
                yield made(length)
        for length in list(held):
            yield made(length)

    once = vectors.select(F.col(column).cast("array<double>").alias("v")).mapInArrow(coded, "length int, code binary")
    return once.distinct().mapInArrow(gathered, "length int, rows int, width int, data binary")


def _matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for length, width, data in zip(*(batch.column(c) for c in ("length", "width", "data")), strict=True):
            yield np.frombuffer(data.as_buffer(), f"<i{width.as_py()}").reshape(-1, length.as_py())


def sums(blocks: DataFrame, length: int) -> list[int]:
    """Exact sum of each entry over the vectors of the blocks."""

    def added(batches):
        total = [0] * length
        for q in _matrices(batches):
            wide = q.astype(np.int64)
            safe = np.abs(wide).max() < (1 << 62) // len(wide)
            total = [a + int(b) for a, b in zip(total, (wide if safe else wide.astype(object)).sum(axis=0))]
        kinds = (list(range(length)), pa.int32()), ([str(t) for t in total], pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in kinds], names=["entry", "total"])

    parts = blocks.mapInArrow(added, "entry int, total string").withColumn("total", F.col("total").cast("decimal(38,0)"))
    found = {r["entry"]: int(r["total"]) for r in parts.groupBy("entry").agg(F.sum("total").alias("total")).collect()}
    return [found[k] for k in range(length)]


def over_vectors(blocks: DataFrame, mean: np.ndarray, figures: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of ``figures`` of the centred vectors, a flat array."""

    def partial(batches):
        total = None
        for q in _matrices(batches):
            own = figures(q - mean)
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId() // FAN_IN], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                names=["slot", "data"],
            )

    def merged(table: pa.Table) -> pa.Table:
        return pa.table({"data": [sum(np.frombuffer(x.as_py()) for x in table["data"]).tobytes()]})

    rows = blocks.select("length", "width", "data")
    parts = rows.mapInArrow(partial, "slot int, data binary")
    if rows.rdd.getNumPartitions() > FAN_IN:
        parts = parts.groupBy("slot").applyInArrow(merged, "data binary")
    return sum(np.frombuffer(r["data"]) for r in parts.collect())


class Covariance:
    """Products of the covariance of the stored vectors with blocks of directions."""

    def __init__(self, blocks: DataFrame, mean: np.ndarray, count: int):
        self.blocks, self.mean, self.count, self.passes = blocks, mean, count, 0

    def times(self, q: np.ndarray) -> np.ndarray:
        self.passes += 1
        return over_vectors(self.blocks, self.mean, lambda x: (x.T @ (x @ q)).ravel()).reshape(q.shape) / self.count

    def trace(self) -> float:
        return float(over_vectors(self.blocks, self.mean, lambda x: np.array([np.vdot(x, x)]))[0]) / self.count

    def whitened_error(self, w: np.ndarray) -> float:
        """Largest absolute entry of the covariance of the vectors projected on ``w``, minus the identity."""
        size = w.shape[1]

        def moments(x):
            z = x @ w
            return np.concatenate([(z.T @ z).ravel(), z.sum(axis=0)])

        found = over_vectors(self.blocks, self.mean, moments) / self.count
        middle = found[size * size :]
        return float(np.abs(found[: size * size].reshape(size, size) - np.outer(middle, middle) - np.eye(size)).max())


def _filtered(times, q: np.ndarray, degree: int, low: float, cut: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial of the matrix, bounded on [low, cut] and 1 at ``top``, times ``q``."""
    half, middle = (cut - low) / 2, (cut + low) / 2
    first = half / (top - middle)
    sigma, before, now = first, q, (times(q) - middle * q) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (2 * following / half) * (times(now) - middle * now) - sigma * following * before
        sigma = following
    return now


def least(times, length: int, steps: int) -> float:
    """About the least eigenvalue, rather below than above it, by Lanczos steps from a random vector."""
    basis = [np.random.RandomState(6).standard_normal(length)]
    basis[0] /= np.linalg.norm(basis[0])
    diagonal, beside = [], []
    for _ in range(min(steps, length)):
        step = times(basis[-1][:, None])[:, 0]
        diagonal.append(float(step @ basis[-1]))
        held = np.array(basis)
        for _ in range(2):  # once more for what rounding left
            step = step - held.T @ (held @ step)
        norm = float(np.linalg.norm(step))
        values, turn = np.linalg.eigh(np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1))
        if norm <= 1e-12 * max(abs(values[-1]), 1e-300):
            return float(values[0])
        beside.append(norm)
        basis.append(step / norm)
    return float(values[0] - norm * abs(turn[-1, 0]))


def leading(times: Callable[[np.ndarray], np.ndarray], length: int, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """``(values, vectors, residual)``: the ``k`` largest eigenpairs of a symmetric matrix without negative eigenvalues."""
    width = min(length, WIDTH * k)
    q = np.linalg.qr(np.random.RandomState(5).standard_normal((length, width)))[0]
    last, low = math.inf, max(0.0, least(times, length, LANCZOS)) if width < length else 0.0
    for _ in range(ROUNDS):
        product = times(q)
        small = q.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, product = q @ turn, product @ turn
        top = float(values[0])
        if top <= 0:
            return np.zeros(k), q[:, :k], 0.0
        residual = float(np.linalg.norm(product - q * values, axis=0)[:k].max()) / top
        if residual <= TOLERANCE or width == length or (residual <= SETTLED and residual > last / 2):
            return values[:k], q[:, :k], residual
        last = residual
        cut = float(max(values[-1], 1e-12 * top))
        if cut <= low * (1 + 1e-9):
            low = 0.0
        lift = math.acosh(max(1.0, 1 + 2 * (float(values[k - 1]) - cut) / (cut - low)))
        needed = math.log(10 * residual / TOLERANCE) / max(lift, 1e-3)
        # The cut rises while the block turns, so the first polynomials are short.
        degree = int(min(max(needed, 2), DEGREE if residual < 1e-2 else 8))
        q = np.linalg.qr(_filtered(times, q, degree, low, cut, top))[0]
    raise ArithmeticError(f"no certified components after {ROUNDS} rounds: residual {residual:.1e}")


def whiten(vectors: DataFrame, k: int = 16, *, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``k`` whitened components of each vector, see ``RESULT``; ``explained`` is a component's share of the variance."""
    spark = vectors.sparkSession
    room = common.scratch(spark, "whitening")
    blocks = room.save(blocks_of(vectors, column), "blocks")
    sizes = blocks.groupBy("length").agg(F.sum("rows").alias("n")).collect()  # one row a length
    empty = spark.createDataFrame([], RESULT)
    if not sizes:
        room.close()
        return empty
    length, count = max(((r["length"], r["n"]) for r in sizes), key=lambda x: (x[1], x[0]))
    blocks = blocks.where(F.col("length") == length).persist()
    total = sums(blocks, length)
    mean = np.array([t / count for t in total])
    cover = Covariance(blocks, mean, count)
    values, found, _ = leading(cover.times, length, min(k, length))
    kept = int((values > 1e-13 * max(length, 1) * values[0]).sum()) if values[0] > 0 else 0
    if not kept:
        blocks.unpersist()
        room.close()
        return empty
    scaled = found[:, :kept] / np.sqrt(values[:kept])
    shares, error = values[:kept] / cover.trace(), cover.whitened_error(scaled)
    blocks.unpersist()  # what follows needs only the small figures above
    room.close()

    def deviations(q: np.ndarray) -> list[int | None]:
        most = max(abs(int(q.max())), abs(int(q.min()))) * count + max(abs(t) for t in total)
        exact = np.int64 if length * most * most < 1 << 63 else object
        gaps = q.astype(exact) * count - np.array(total, dtype=exact)
        return [int(x) if x < 1 << 63 else None for x in (gaps * gaps).sum(axis=1)]

    def projected(batches):
        for batch in batches:
            ids = batch.column(0)
            for rows, q in quantised(batch.column(1)):
                if q.shape[1] != length:
                    continue
                n = len(rows) * kept
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(np.repeat(rows, kept))),
                        pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(n, count)),
                        pa.array(deviations(q), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), kept))),
                        pa.array(((q - mean) @ scaled).ravel()),
                        pa.array(np.tile(shares, len(rows))),
                        pa.array(np.full(n, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v"))
    return rows.mapInArrow(projected, RESULT)
