"""Whitening of embeddings by a one-sided Jacobi SVD over blockwise TSQR.

No covariance matrix is formed. Tasks centre their rows and reduce them, block after block, to the
triangular factor of a QR decomposition; factors meet in a tree, some at a time, until one is left.
Plane rotations then orthogonalise the columns of that factor: the accumulated rotations are the
components, the column norms the singular values, small ones as accurate as large ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

#: Components that are reported, rows of a QR block, and factors that meet in one task of the tree.
COMPONENTS, BLOCK_ROWS, FAN_IN = 16, 4_096, 16
#: Units of an entry, and what is added so that all are positive.
SCALE, SHIFT = 64, 1_000_000
#: A component is reported if its deviation is above this share of the largest: smaller ones are rounding.
LEAST = 1e-10


def jacobi(r: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of a matrix, falling, and its right singular vectors as columns.

    Each round of a sweep rotates disjoint pairs of columns at once, as in a round-robin tournament,
    so that both become orthogonal; it ends when no pair is farther from that than rounding.
    """
    d = r.shape[1]
    a, v = np.array(r, float), np.eye(d)
    if d > 1:
        seats = np.arange(d + d % 2)  # an odd number of columns has one seat that rests
        for _ in range(sweeps):
            worst = 0.0
            for _ in range(len(seats) - 1):
                p, q = seats[: len(seats) // 2], seats[len(seats) // 2 :][::-1]
                real = (p < d) & (q < d)
                p, q = p[real], q[real]
                x, y = a[:, p], a[:, q]
                xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
                size = np.sqrt(xx * yy)
                off = np.divide(np.abs(xy), size, out=np.zeros_like(xy), where=size > 0)
                worst = max(worst, off.max(initial=0.0))
                turn = off > 1e-16
                z = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
                t = np.where(turn, np.where(z < 0, -1.0, 1.0) / (np.abs(z) + np.hypot(1.0, z)), 0.0)
                c = 1 / np.hypot(1.0, t)
                s = c * t
                for m in (a, v):
                    x, y = m[:, p], m[:, q]
                    m[:, p], m[:, q] = c * x - s * y, s * x + c * y
                seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
            if worst < 1e-15 * max(1, d):
                break
        else:
            raise ArithmeticError("the rotations did not converge")
    size = np.sqrt((a * a).sum(0))
    order = np.argsort(-size, kind="stable")
    return size[order], v[:, order]


def as_integers(vectors: DataFrame, column: str) -> DataFrame:
    """The rows whose vector is there and has finite entries only, with `_x`, its entries as whole numbers."""
    v = F.col(f"`{column}`")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.where(v.isNotNull() & finite).withColumn("_x", F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT))


def _matrix(column, dims: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths != dims).any():
        raise ValueError(f"vectors have {dims} and {lengths[lengths != dims][0]} dimensions")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _rounded(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n, from the exact n x - S."""
    return (x * n - sums) / n


def _columns_summed(df: DataFrame) -> np.ndarray:
    """The sums of arrays of equal length, place by place, added up by Spark."""
    each = df.select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    return np.array([r["v"] for r in sorted(each, key=lambda r: r["at"])])


def _factor(fit: DataFrame, n: int, sums: np.ndarray, fan_in: int = FAN_IN) -> np.ndarray:
    """The triangular factor of the centred rows, by a tree of QR decompositions."""
    d = len(sums)

    def first(batches: Iterator) -> Iterator:
        import pyarrow as pa

        r = np.zeros((0, d))
        for b in batches:
            x = _matrix(b.column(0), d)
            for k in range(0, len(x), BLOCK_ROWS):
                r = np.linalg.qr(np.vstack([r, _rounded(x[k : k + BLOCK_ROWS], n, sums)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.astype("<f8").tobytes()])], names=["r"])

    def meet(batches: Iterator) -> Iterator:
        import pyarrow as pa

        r = np.zeros((0, d))
        for b in batches:
            for part in b.column(0).to_pylist():
                r = np.linalg.qr(np.vstack([r, np.frombuffer(part, "<f8").reshape(-1, d)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.astype("<f8").tobytes()])], names=["r"])

    factors = cut(fit.mapInArrow(first, "r binary"))
    while (left := factors.count()) > fan_in:
        factors = cut(factors.repartition(-(-left // fan_in)).mapInArrow(meet, "r binary"))
    parts = [np.frombuffer(x["r"], "<f8").reshape(-1, d) for x in factors.collect()]  # FAN_IN at most
    return np.linalg.qr(np.vstack([*parts, np.zeros((d, d))]), mode="r")


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, a row for each vector and component.

    Vectors that are null, or hold null or entries that are not finite, are left out. Entries become
    whole numbers (as_integers), and the components are those of the distinct vectors, n of them with
    sums S. Component 1 has the largest eigenvalue e of their covariance. deviation (decimal) is the
    exact sum of (n x - S) squared, whitened is x - S / n along the component in units of sqrt(e),
    explained is e over the covariance's trace, and identity_error the largest entry of the whitened
    fit list's covariance less the identity, measured, not derived.

    There are at most `components` components, and none for directions without deviation: fewer
    dimensions, fewer distinct vectors or dependent dimensions give fewer, a single distinct vector
    none and so no rows. Where eigenvalues tie, any basis of their space may come. Repeated rows and
    null ids are rows like others. Vectors of different lengths fail the job. An empty table gives
    no rows. Other columns are not read. Only distinct vectors, once, are shuffled.
    """
    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows = as_integers(vectors, vector_col).select(F.col(id_col).alias("vec_id"), "_x")
    fit = cut(rows.select("_x").distinct())
    widths = [r[0] for r in fit.select(F.size("_x")).distinct().limit(2).collect()]
    if len(widths) > 1:
        raise ValueError(f"vectors have {widths[0]} and {widths[1]} dimensions")
    n = fit.count()
    if not n or not widths[0]:
        return spark.createDataFrame([], schema)
    d = widths[0]

    def added(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(d, np.int64)
        for b in batches:
            total += _matrix(b.column(0), d).sum(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], names=["v"])

    sums = _columns_summed(fit.mapInArrow(added, "v array<long>")).astype(np.int64)
    sigma, axes = jacobi(_factor(fit, n, sums))
    eigen = sigma**2 / n
    k = int((sigma[:components] > LEAST * sigma[0]).sum()) if sigma[0] > 0 else 0
    if not k:
        return spark.createDataFrame([], schema)
    scaled, explained = axes[:, :k] / np.sqrt(eigen[:k]), eigen[:k] / eigen.sum()

    def squared(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros((k + 1, k))
        for b in batches:
            w = _rounded(_matrix(b.column(0), d), n, sums) @ scaled
            total[:k] += w.T @ w
            total[k] += w.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["v"])

    *second, first = _columns_summed(fit.mapInArrow(squared, "v array<double>")).reshape(k + 1, k) / n
    error = float(np.abs(np.array(second) - np.outer(first, first) - np.eye(k)).max())

    def project(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                b = whole.slice(at, BLOCK_ROWS)
                away = _matrix(b.column(1), d) * n - sums
                if float(np.abs(away).max(initial=0)) ** 2 * d < 2.0**62:
                    deviation = pa.array((away * away).sum(1)).cast(pa.decimal128(38, 0))
                else:
                    from decimal import Decimal

                    deviation = pa.array([Decimal(sum(y * y for y in x)) for x in away.tolist()], pa.decimal128(38, 0))
                m = b.num_rows
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), deviation.take(each),
                        pa.array(((away / n) @ scaled).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(project, schema)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))
