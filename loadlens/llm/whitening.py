"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import write_table

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Tasks that add up the partial sums of all others.
ADDERS = 8
#: A component below this share of the total variance is rounding, not variance.
NO_VARIANCE = 1e-13


@dataclass
class Blocks:
    """Centred rows of a matrix, packed: a stored table (ids, x), one block of rows per record."""

    table: DataFrame
    width: int
    dtype: str
    n: int = 0
    sums: np.ndarray | None = None

    def summed(self, part: Callable[[np.ndarray], np.ndarray], exact: bool = False) -> np.ndarray | None:
        """The sum over all blocks of ``part(rows)``; None without rows.

        ``part`` gets the whole-number rows of one block. Each task adds its own
        blocks, a fixed number of tasks add these sums, the driver the last few.
        """
        kind, width, dtype = ("<i8" if exact else "<f8"), self.width, self.dtype

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for raw in batch.column("x"):
                    more = np.asarray(part(np.frombuffer(raw.as_buffer(), dtype).reshape(-1, width)), kind)
                    total = more if total is None else total + more
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for raw in batch.column("s"):
                    more = np.frombuffer(raw.as_buffer(), kind)
                    total = more if total is None else total + more
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

        last = self.table.select("x").mapInArrow(run, "s binary").repartition(ADDERS).mapInArrow(add, "s binary").collect()
        return sum(np.frombuffer(r.s, kind) for r in last) if last else None

    def centring(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function that takes the mean off rows, rounded once: the difference is taken in whole numbers."""
        n, sums = self.n, self.sums
        return lambda rows: (rows.astype(np.int64) * n - sums) / float(n)


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): entries as whole numbers, without vectors that are NULL or hold NULL or non-finite entries."""
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform(vector, lambda c: (F.floor(c.cast("double") * SCALE) + SHIFT).cast("bigint"))
    return rows.where(F.col(vector).isNotNull() & finite).select(F.col(vec_id).alias("vec_id"), x.alias("x"))


def pack(vectors: DataFrame) -> Blocks | None:
    """Store vectors (vec_id, x) in packed blocks and add up their columns exactly; None without any.

    The width is the commonest length (the greater one on a tie); vectors of
    another length, and empty ones, are left out.
    """
    sizes = vectors.where(F.size("x") > 0).groupBy(F.size("x").alias("width"))
    common = sizes.agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("x", F.abs))).alias("top")).orderBy(F.desc("n"), F.desc("width")).first()
    if common is None:
        return None
    width, dtype = common.width, ("<i4" if common.top < 2**31 else "<i8")
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(dtype)
                ids = batch.column("vec_id")
                listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([listed, pa.array([flat.tobytes()], pa.binary())], ["ids", "x"])

    packed = vectors.where(F.size("x") == width).mapInArrow(run, f"ids array<{kind}>, x binary")
    blocks = Blocks(write_table(packed, "vectors"), width, dtype)
    counted = blocks.summed(lambda x: np.append(x.sum(axis=0, dtype=np.int64), len(x)), exact=True)
    blocks.n, blocks.sums = int(counted[-1]), counted[:-1]
    return blocks


def _unit(v: np.ndarray, basis: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """``v`` without its parts along ``basis`` (taken out twice), and its length before scaling to 1."""
    for _ in range(2):
        for b in basis:
            v = v - b * (b @ v)
    size = float(np.linalg.norm(v))
    return (v / size if size else v), size


def bidiagonalise(blocks: Blocks, steps: int | None = None, tolerance: float | None = None, wanted: int = 8, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Right vectors V (columns) and upper bidiagonal B with X V = U B for the centred rows X.

    Every step reads the blocks once: w = X q, where q = v minus the part along
    the left vector before it, and then Xᵀw. A left vector is as long as the
    table, so it is never stored: u = X p with a short p, and a task forms its
    part of u from its rows. Against rounding, both sides are orthogonalised
    again against all earlier vectors in every step; the left side through
    Uᵀw = Pᵀ(Xᵀw), with another pass where that took much away. Where the
    vectors reached so far span an invariant space, a new random direction
    starts the next one, so equal eigenvalues are all found.

    By default all dimensions are done, which gives the whole spectrum. With
    ``tolerance`` it ends once the ``wanted`` greatest values have a residual
    below that share of the greatest one.
    """
    width = blocks.width
    rng = np.random.default_rng(seed)
    right: list[np.ndarray] = []
    short: list[np.ndarray] = []  # p of each left vector
    images: list[np.ndarray] = []  # Xᵀu of each left vector
    upper = np.zeros((width, width))
    centred = blocks.centring()

    def both(q: np.ndarray) -> tuple[np.ndarray, float]:
        def part(rows: np.ndarray) -> np.ndarray:
            x = centred(rows)
            w = x @ q
            return np.append(w @ x, w @ w)

        got = blocks.summed(part)
        return got[:-1], float(got[-1])

    v, _ = _unit(rng.standard_normal(width), right)
    beta, scale = 0.0, 0.0
    for k in range(min(width, steps or width)):
        right.append(v)
        q = v - beta * short[-1] if beta else v
        image, square = both(q)
        for _ in range(3):
            along = np.array([p @ image for p in short])
            gone = float(along @ along)
            q = q - sum((a * p for a, p in zip(along, short)), np.zeros(width))
            if gone <= 1e-6 * square:
                image = image - sum((a * z for a, z in zip(along, images)), np.zeros(width))
                square = max(square - gone, 0.0)
                break
            image, square = both(q)
        alpha = float(np.sqrt(square))
        scale = max(scale, alpha)
        tiny = 1e-14 * scale * np.sqrt(width)
        if alpha > tiny:
            short.append(q / alpha)
            images.append(image / alpha)
            v, beta = _unit(images[-1] - alpha * v, right)
        else:  # no variance along this direction
            alpha, beta = 0.0, 0.0
            short.append(np.zeros(width))
            images.append(np.zeros(width))
        upper[k, k] = alpha
        if k + 1 == width:
            break
        if beta <= tiny:
            beta = 0.0
            v, _ = _unit(rng.standard_normal(width), right)
        upper[k, k + 1] = beta
        if tolerance is not None and k + 1 >= min(wanted, width):
            y, s, _ = np.linalg.svd(upper[: k + 1, : k + 1])
            if np.all(np.abs(beta * y[-1, :wanted]) <= tolerance * s[0]):
                break
    done = len(right)
    return np.array(right).T, upper[:done, :done]


@dataclass
class Whitening:
    """Components (columns, unit length) by falling eigenvalue of the covariance, divisor n."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def fit(blocks: Blocks, components: int = 8, steps: int | None = None, tolerance: float | None = None) -> Whitening:
    """The first components, from the singular values of the small bidiagonal matrix.

    Components without variance cannot be scaled to variance 1 and are left
    out; equal eigenvalues get any orthogonal components of their space.
    """
    right, upper = bidiagonalise(blocks, steps, tolerance, components)
    _, singular, turned = np.linalg.svd(upper)
    values = singular**2 / blocks.n
    centred = blocks.centring()
    trace = float(blocks.summed(lambda rows: np.array([np.square(centred(rows)).sum()]))[0]) / blocks.n
    kept = [i for i in range(min(components, len(values))) if values[i] > NO_VARIANCE * trace]
    basis = np.linalg.qr((right @ turned.T)[:, kept])[0]  # signs may turn; the directions are orthogonal already
    whitening = Whitening(blocks.n, blocks.sums, basis, values[kept], trace, 0.0)
    if kept:
        size, to = len(kept), basis / np.sqrt(whitening.eigenvalues)

        def moments(rows: np.ndarray) -> np.ndarray:
            w = centred(rows) @ to
            return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

        got = blocks.summed(moments) / blocks.n
        covariance = got[size:].reshape(size, size) - np.outer(got[:size], got[:size])
        whitening.identity_error = float(np.abs(covariance - np.eye(size)).max())
    return whitening


def apply(blocks: Blocks, whitening: Whitening) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` is the exact sum of (n x - S)²; a value beyond a long raises.
    """
    kind = blocks.table.schema["ids"].dataType.elementType.simpleString()
    to = whitening.components / np.sqrt(whitening.eigenvalues)
    size, width, dtype = to.shape[1], blocks.width, blocks.dtype
    n, sums, shares = whitening.n, whitening.sums, whitening.eigenvalues / whitening.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, raw in zip(batch.column("ids"), batch.column("x")):
                away = np.frombuffer(raw.as_buffer(), dtype).reshape(-1, width).astype(np.int64) * n - sums
                if np.square(away.astype(float)).sum(axis=1).max() > 9.2e18:
                    raise OverflowError("the deviation does not fit into 64 bits")
                deviation = np.square(away).sum(axis=1)
                whitened = (away / float(n)) @ to
                rows = len(away)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(pa.array(np.repeat(np.arange(rows), size))),
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), rows)),
                        pa.array(np.repeat(deviation, size)),
                        pa.array(whitened.ravel()),
                        pa.array(np.tile(shares, rows)),
                    ],
                    ["vec_id", "component", "deviation", "whitened", "explained"],
                )

    rows = blocks.table.mapInArrow(run, f"vec_id {kind}, component int, deviation long, whitened double, explained double")
    return rows.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(whitening.identity_error).alias("identity_error"))


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """Whitened coordinates of every usable vector along the first components.

    A NULL or repeated id is a row like any other, and so is a repeated vector;
    other columns are not read. Without a usable vector, or where all are equal
    (no variance), the result is empty.
    """
    vectors = whole_vectors(rows, vec_id, vector)
    blocks = pack(vectors)
    whitening = fit(blocks, components) if blocks else None
    if whitening is None or not whitening.components.shape[1]:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return rows.sparkSession.createDataFrame([], schema)
    return apply(blocks, whitening)
