"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The fit list, a table of different vectors, stays on the executors. A step is one pass over it: each
task multiplies its centred rows by a right vector (Xv), measures what the product has in common with
all earlier left vectors, and multiplies the transposed rows by it (X'u). Only sums as long as a vector
reach the driver, which orthogonalises them fully against all earlier ones. After as many steps as
there are dimensions, the singular values and right vectors of the small bidiagonal matrix give the
components and deviations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listflow.llm.frames import fresh, schema_with
from listflow.session import cut_lineage

#: Rows that a task multiplies at once, and partial sums that the driver adds.
BLOCK_ROWS = 8192
MOST_PARTS = 256
#: A new direction shorter than this part of the longest one so far is rounding error.
NOISE = 1e-12


def scaled(vectors: DataFrame, vector: str, into: str, scale: int = 256) -> DataFrame:
    """Rows whose vector holds only finite entries, with ``into``: floor(``scale`` * entry) as longs."""
    entry = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    bad = F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.filter(F.col(f"`{vector}`").isNotNull() & ~bad).withColumn(
        into, F.transform(entry, lambda c: F.floor(c * scale).cast("long")))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """(rows, ``width``) of longs from lists of any lengths; a shorter one ends in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def blocks(batches: Iterator[pa.RecordBatch], column: str, width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            yield matrix(batch[column].slice(at, BLOCK_ROWS), width)


def summed(rows: DataFrame, tasks: int, work: Callable[[np.ndarray], np.ndarray], column: str, width: int,
           size: int) -> np.ndarray:
    """The sum of ``work`` (``size`` doubles) over all blocks of rows: one sum a task, then sums of those, then the driver's."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros(size), False
        for block in blocks(batches, column, width):
            total, any_rows = total + work(block), True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros(size), False
        for batch in batches:
            for p in batch["part"].to_pylist():
                total, any_rows = total + np.frombuffer(p), True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = rows.mapInArrow(part, "part binary")
    while tasks > MOST_PARTS:
        tasks = -(-tasks // MOST_PARTS)
        parts = parts.repartition(tasks).mapInArrow(add, "part binary")
    out = np.zeros(size)
    for (p,) in parts.collect():
        out = out + np.frombuffer(bytes(p))
    return out


def exact_sums(rows: DataFrame, column: str, width: int) -> tuple[int, list[int]]:
    """(rows, per-dimension sums) as whole numbers of any size."""
    each = rows.select(F.posexplode(column).alias("d", "x")).groupBy("d").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"))
    sums = {r["d"]: int(r["s"]) for r in each.collect()}
    return rows.count(), [sums.get(d, 0) for d in range(width)]


def bidiagonal(rows: DataFrame, tasks: int, column: str, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(V, B): X V = U B for the centred rows X, V orthonormal (width, width), B upper bidiagonal.

    A left vector is a centred row times a short vector, so it is computed anew in each pass instead of
    kept. Where a direction turns out empty (a rank below the width, equal singular values), the search
    goes on from a new one orthogonal to all before, so that every dimension is covered.
    """
    width = len(mean)
    draw = np.random.default_rng(13)
    right, left, images = np.zeros((width, 0)), np.zeros((width, 0)), np.zeros((width, 0))
    b = np.zeros((width, width))
    scale = 0.0

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(3):
            v = v - right @ (right.T @ v)
        return v

    def product(g: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """(squared length of Xg, its products with the left vectors, X'Xg)."""
        known = left.shape[1]

        def work(block: np.ndarray) -> np.ndarray:
            x = block - mean
            u = x @ g
            return np.concatenate([[u @ u], (x @ left).T @ u, x.T @ u])

        out = summed(rows, tasks, work, column, width, 1 + known + width)
        return out[0], out[1:1 + known], out[1 + known:]

    following, beta = None, 0.0
    for j in range(width):
        v = following
        if v is None:
            v, beta = orthogonal(draw.standard_normal(width)), 0.0
            v = v / np.linalg.norm(v)
        b[j - 1, j] = beta if j else 0.0
        # Xv less what the last left vector has of it, then less what any has
        g = v - beta * left[:, -1] if beta else v
        for _ in range(3):
            squared, common, image = product(g)
            g = g - left @ common
            if np.linalg.norm(common) <= 1e-8 * np.sqrt(squared):
                break
        image = image - images @ common
        alpha = np.sqrt(max(squared - common @ common, 0.0))
        right = np.column_stack([right, v])
        scale = max(scale, alpha, beta)
        following = None
        if alpha <= NOISE * scale or alpha == 0:
            continue
        b[j, j] = alpha
        left, images = np.column_stack([left, g / alpha]), np.column_stack([images, image / alpha])
        w = orthogonal(image / alpha - alpha * v)
        beta = np.linalg.norm(w)
        scale = max(scale, beta)
        if beta > NOISE * scale:
            following = w / beta
    return right, b


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 4,
           scale: int = 256) -> DataFrame:
    """One row per remaining row and component: ``key``, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds a null or non-finite entry go. x is floor(``scale`` * entry); the
    fit list holds each different x once. ``deviation`` is exact, and null where it exceeds a long.
    Components have a positive deviation: those beyond the rank of the fit list are left out, so a table
    whose vectors are all equal, like an empty one, gives no rows. Vectors of several lengths count as
    ended by zeros. Null and repeated keys stay, a row each; other columns are not read.
    """
    x = fresh(vectors, "x")
    own = scaled(vectors.select(f"`{key}`", f"`{vector}`"), vector, x, scale).select(f"`{key}`", x)
    schema = schema_with(own, [key], "component int, n long, deviation long, whitened double, explained double, identity_error double")
    width = own.agg(F.max(F.size(x))).first()[0] or 0
    spark = vectors.sparkSession
    if not width:
        return spark.createDataFrame([], schema)
    ended = F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(x)))
    rows = cut_lineage(own.select(ended.alias("x")).groupBy("x").agg(F.count("*").alias("copies")).select("x"), "vectors")
    n, sums = exact_sums(rows, "x", width)
    mean = np.array([s / n for s in sums])
    tasks = rows.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0] + 1
    right, b = bidiagonal(rows, tasks, "x", mean)
    _, singular, turned = np.linalg.svd(b)
    rank = int((singular > NOISE * 10 * singular[0]).sum()) if singular[0] > 0 else 0
    count = min(components, rank)
    if not count:
        return spark.createDataFrame([], schema)
    # X = U B V', so the rows of turned are the components in the coordinates of V
    axes = right @ turned[:count].T
    project = axes * (np.sqrt(n) / singular[:count])

    def squares(block: np.ndarray) -> np.ndarray:
        centred = block - mean
        y = centred @ project
        return np.concatenate([[(centred ** 2).sum()], y.sum(axis=0), (y.T @ y).ravel()])

    found = summed(rows, tasks, squares, "x", width, 1 + count + count * count)
    explained = singular[:count] ** 2 / found[0]
    middle = found[1:1 + count] / n
    error = float(np.abs(found[1 + count:].reshape(count, count) / n - np.outer(middle, middle) - np.eye(count)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                block = matrix(part[x], width)
                size, each = len(block), np.tile(np.arange(count, dtype=np.int32), len(block))
                y = (block - mean) @ project
                yield pa.RecordBatch.from_arrays(
                    [part[key].take(pa.array(np.repeat(np.arange(size), count))), pa.array(each + 1, pa.int32()),
                     pa.array(np.full(size * count, n), pa.int64()),
                     deviations(block, n, sums).take(pa.array(np.repeat(np.arange(size), count))), pa.array(y.ravel()),
                     pa.array(explained[each]), pa.array(np.full(size * count, error))], names=schema.names)

    return own.mapInArrow(run, schema)


def deviations(block: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Per row the exact sum of (n * x - S)^2; null where it is no long."""
    largest = n * int(np.abs(block).max(initial=0)) + max(map(abs, sums), default=0)
    if len(sums) * largest ** 2 < 2 ** 63:
        return pa.array(((n * block - np.array(sums, np.int64)) ** 2).sum(axis=1))
    exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums)) for row in block.tolist()]
    return pa.array([e if e < 2 ** 63 else None for e in exact], pa.int64())
