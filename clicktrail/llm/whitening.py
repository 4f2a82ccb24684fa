"""Whitening of embeddings by their leading principal components, found by filtered subspace iteration.

The covariance is never formed.  A pass over the distributed vectors multiplies it with a few columns; a Chebyshev
recurrence of such passes damps the part of the spectrum that is not wanted, then the columns are made orthonormal
and rotated by Rayleigh-Ritz.  That goes on until the residuals certify the wanted eigenvectors.  Where the spectrum
is so flat that a block makes no progress the block grows; as wide as the vectors it is exact at once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktrail.llm.store import staged

SCALE = 256
COMPONENTS = 4
#: Columns of a block beyond the wanted ones.
GUARD = 28
ROUNDS = 6  # of a block, before it grows
LARGEST_DEGREE = 24
#: Residual over the distance to the nearest other eigenvalue; and residual over the largest eigenvalue that rounding leaves.
CLOSE, ROUNDED = 1e-11, 2e-15
#: Eigenvalues below this share of the largest are zeros.
ZERO = 1e-12
SEED = 20240817


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.ListArray) else pc.list_flatten(column)
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and ``x``, the entries times SCALE rounded down, of the rows whose entries are all finite numbers."""
    finite = "embedding is not null and forall(embedding, c -> c is not null and not isnan(c) and abs(c) < double('Infinity'))"
    x = f"transform(embedding, c -> floor({SCALE}D * cast(c as double)) + 0L)"
    return vectors.select("vec_id", "embedding").where(finite).select("vec_id", F.expr(x).alias("x"))


def _summed(fit: DataFrame, rows: int, columns: int, terms: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of ``terms`` (rows x columns, of a matrix of vectors), added up in tasks and shuffled by row."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rows, columns))
        for batch in batches:
            if batch.num_rows:
                total += terms(_matrix(batch.column("x")))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(rows, dtype=np.int32)), *(pa.array(c) for c in total.T)], names=["row", *(f"c{j}" for j in range(columns))]
        )

    names = [f"c{j}" for j in range(columns)]
    parts = fit.mapInArrow(partial, "row int, " + ", ".join(f"{c} double" for c in names))
    out = np.zeros((rows, columns))
    for r in parts.groupBy("row").agg(*[F.sum(c).alias(c) for c in names]).collect():
        out[r["row"]] = r[1:]
    return out


def _moments(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """How many vectors there are, and the exact sum of each entry."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                n += len(x)
                high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
                total = [t + (h << 32) + w for t, h, w in zip(total, high.tolist(), low.tolist(), strict=True)]
        dims = list(range(-1, width))
        yield pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), pa.array([str(t) for t in (n, *total)])], names=["dim", "total"])

    sums = fit.mapInArrow(partial, "dim int, total string").groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = {r["dim"]: int(r["total"]) for r in sums.collect()}
    return found.get(-1, 0), [found.get(k, 0) for k in range(width)]


def _degree(values: np.ndarray, wanted: int, edge: float, lift: float) -> int:
    """Of a filter that lifts the wanted eigenvalues so far above [0, edge], but the largest of them not too far above the least."""
    t = [math.acosh(max(1.0, 2 * v / edge - 1)) for v in (values[0], values[wanted - 1])]
    if t[1] <= 0:
        return LARGEST_DEGREE
    m = math.ceil(math.acosh(min(1e8, max(100.0, lift))) / t[1])
    if t[0] > t[1]:
        m = min(m, int(math.log(1e9) / (t[0] - t[1])))
    return max(2, min(LARGEST_DEGREE, m))


def principal(multiply: Callable[[np.ndarray], np.ndarray], width: int, wanted: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of the symmetric matrix that ``multiply`` applies to a block of columns.

    There are ``wanted`` at most; zeros of the spectrum have none.
    """
    random = np.random.default_rng(seed)
    wanted = min(wanted, width)
    size = min(width, wanted + GUARD)
    block = np.linalg.qr(random.standard_normal((width, size)))[0]
    product = multiply(block)
    rounds = 0
    while True:
        small = block.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, product = block @ turn, product @ turn
        if values[0] <= 0:
            return values[:0], block[:, :0]
        real = max(1, int((values[:wanted] > ZERO * values[0]).sum()))
        residual = np.linalg.norm(product - block * values, axis=0)[:real]
        apart = np.abs(values[:real, None] - values[None, :])
        apart[np.arange(real), np.arange(real)] = np.inf
        allowed = np.maximum(CLOSE * apart.min(1), ROUNDED * math.sqrt(width) * values[0])
        # One round at least, so that the columns have seen the matrix.
        if size == width or (rounds and (residual <= allowed).all()):
            return values[:real], block[:, :real]
        rounds += 1
        if rounds > ROUNDS:
            size, rounds = min(width, 2 * size), 1
            block = np.linalg.qr(np.hstack((block, random.standard_normal((width, size - block.shape[1])))))[0]
            product = multiply(block)
            continue
        edge = values[-1]
        if edge <= ZERO * values[0]:
            block = np.linalg.qr(product)[0]
        else:
            # The scaled recurrence on [0, edge], whose first step is the product at hand.
            half = edge / 2
            first = sigma = half / (values[0] - half)
            before, now = block, (product - half * block) * (sigma / half)
            for _ in range(_degree(values, real, edge, 10 * float((residual / allowed).max())) - 1):
                new = 1 / (2 / first - sigma)
                before, now = now, 2 * (new / half) * (multiply(now) - half * now) - sigma * new * before
                sigma = new
            block = np.linalg.qr(now)[0]
        product = multiply(block)


def _rows(schema_id: str, n: int, sums: list[int], centre: np.ndarray, axes: np.ndarray, explained: list[float], error: float):
    k = axes.shape[1]
    most = max(map(abs, sums))

    def deviations(x: np.ndarray) -> list[int | None]:
        bound = n * max(abs(int(x.min())), abs(int(x.max()))) + most
        if x.shape[1] * bound**2 < 2**63:
            return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
        exact = (sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist())
        return [v if v < 2**63 else None for v in exact]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                m, x = part.num_rows, _matrix(part.column("x"))
                index = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(index),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n)),
                        pa.array(deviations(x), pa.int64()).take(index),
                        pa.array(((x - centre) @ axes).ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row per usable row of ``vectors`` and component.

    Rows whose vector is null or holds null or non-finite entries are dropped, and so are vectors of another length than
    most distinct ones have (of equally many the longest), as they lack entries.  Entries beyond the range of a long
    after scaling stand at its ends.  The components are fitted to each distinct vector once, so copies weigh nothing;
    every row gets its values, repeated rows each theirs.  Components whose eigenvalue is zero do not exist: equal
    vectors, one vector, empty vectors or an empty table give no rows.  ``deviation`` is null where a long cannot hold it.
    Other columns are not read.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    out = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    nothing = spark.createDataFrame([], out)
    x = integer_vectors(vectors)
    fit = staged(x.select("x").distinct(), "fit")
    usual = fit.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if usual is None or usual["width"] == 0:
        return nothing
    width = usual["width"]
    fit = fit.where(F.size("x") == width)
    n, sums = _moments(fit, width)
    centre = np.array([s / n for s in sums])

    def multiply(block: np.ndarray) -> np.ndarray:
        def terms(x: np.ndarray) -> np.ndarray:
            z = x - centre
            return z.T @ (z @ block)

        return _summed(fit, width, block.shape[1], terms) / n

    values, axes = principal(multiply, width, components)
    if not len(values):
        return nothing
    k = len(values)
    scaled = axes / np.sqrt(values)

    def check(x: np.ndarray) -> np.ndarray:
        z = x - centre
        white = z @ scaled
        out = np.zeros((k + 2, k))
        out[:k], out[k], out[k + 1, 0] = white.T @ white, white.sum(0), (z * z).sum()
        return out

    checked = _summed(fit, k + 2, k, check) / n
    error = float(np.abs(checked[:k] - np.outer(checked[k], checked[k]) - np.eye(k)).max())
    explained = (values / checked[k + 1, 0]).tolist()
    return x.where(F.size("x") == width).mapInArrow(_rows(id_type, n, sums, centre, scaled, explained, error), out)
