"""Whitening of embeddings by their largest principal components (operator 12).

Entries become whole numbers, so that sums are exact.  Each distinct vector
counts once (one distinct, partial before its shuffle); the sums and then the
covariance about the mean's nearest whole numbers are added up task by task:
products of whole numbers, exact as doubles up to 2^53, then corrected by the
mean's fraction, so neither the order of the tasks nor a lost executor changes
them.  The driver holds matrices of dimension by dimension only; ``feast``
finds the largest eigenpairs.  The error of the whitened covariance is measured
on the vectors once more, not derived.

Cases: vectors that are null or empty, hold a null, NaN, infinite or too large
entry (its whole number wouldn't be a long), or whose length isn't the commonest
one (of equally common lengths the largest counts) are dropped; null and
repeated ids give rows like any others; components without variance (against
rounding) are none, so a table of equal vectors, or an empty one, gives no rows;
of equal eigenvalues the components are any basis, the same for all rows; a
``deviation`` that is no long is null; other columns aren't read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtide.llm import feast
from claimtide.llm.tables import written

# fixed values of the contract: the whole number of an entry
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: entries beyond have no whole number in 64 bits.
LARGEST = float(1 << 56)


class Whitening(NamedTuple):
    n: int
    sums: list[int]  # of the fit list, per dimension
    centre: np.ndarray  # the mean's nearest whole numbers
    fraction: np.ndarray  # mean - centre
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # components as columns
    trace: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre).astype(np.float64) - self.fraction) @ (self.vectors / np.sqrt(self.values))


def whole_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x) of the rows that remain."""
    fine = lambda c: F.coalesce(F.abs(c) < F.lit(LARGEST), F.lit(False))
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where((F.size("v") > 0) & F.forall("v", fine))
    commonest = rows.groupBy(F.size("v").alias("dimension")).count().orderBy(F.desc("count"), F.desc("dimension")).first()
    whole = F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))) + F.lit(OFFSET))
    return rows.where(F.size("v") == (commonest[0] if commonest else 0)).select("id", whole.cast("array<long>").alias("x"))


def _matrix(column) -> np.ndarray:
    """The rows of an Arrow list column whose lists have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of each dimension."""

    def run(batches):
        n, low, high = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                n, low, high = n + len(x), low + (x & 0xFFFFFFFF).sum(0), high + (x >> 32).sum(0)
        if n:
            total = [(int(h) << 32) + int(s) for s, h in zip(low, high, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()), pa.array([str(t) for t in total])], ["i", "n", "s"])

    parts = fit.mapInArrow(run, "i int, n long, s string")
    rows = parts.groupBy("i").agg(F.sum("n"), F.sum(F.col("s").cast("decimal(38,0)"))).orderBy("i").collect()  # a row a dimension
    return (rows[0][1] if rows else 0), [int(r[2]) for r in rows]


def _products(fit: DataFrame, columns) -> np.ndarray:
    """The matrix of ``columns(x).T @ columns(x)`` over all vectors."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                c = columns(_matrix(batch.column("x")))
                total = c.T @ c + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([row.tobytes() for row in total], pa.binary())], ["i", "row"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(row, np.float64) for row in sorted(table["row"].to_pylist()))
        return pa.table({"i": table["i"][:1], "row": pa.array([total.tobytes()], pa.binary())})

    # a group holds one row of the matrix from every task
    rows = fit.mapInArrow(run, "i int, row binary").groupBy("i").applyInArrow(add, "i int, row binary").orderBy("i").collect()
    return np.array([np.frombuffer(r["row"], np.float64) for r in rows])


def fitted(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of distinct vectors (column ``x``); None without variance."""
    n, sums = _sums(fit)
    if n == 0:
        return None
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = [s - n * int(m) for s, m in zip(sums, centre, strict=True)]
    fraction = np.array([r / n for r in rest])
    products = _products(fit, lambda x: (x - centre).astype(np.float64))
    covariance = (products.astype(np.longdouble) / n - np.outer(fraction.astype(np.longdouble), fraction)).astype(np.float64)
    values, vectors = feast.largest(covariance, components)
    trace = float(np.trace(covariance))
    there = values > len(covariance) * np.finfo(float).eps * trace
    if not there.any():
        return None
    return Whitening(n, sums, centre, fraction, values[there], vectors[:, there], trace)


def identity_error(fit: DataFrame, whitening: Whitening) -> float:
    """Largest absolute entry of the whitened covariance minus the identity."""
    products = _products(fit, lambda x: np.concatenate([whitening.whitened(x), np.ones((len(x), 1))], axis=1))
    mean = products[-1, :-1] / whitening.n
    return float(np.abs(products[:-1, :-1] / whitening.n - np.outer(mean, mean) - np.eye(len(mean))).max())


def _deviations(x: np.ndarray, whitening: Whitening) -> list[int | None]:
    """Sums of (n * x - S)^2: whole numbers, null beyond 64 bits."""
    rest = np.array([s - whitening.n * int(m) for s, m in zip(whitening.sums, whitening.centre, strict=True)], object)
    y = x - whitening.centre
    rough = ((whitening.n * y.astype(np.float64) - rest.astype(np.float64)) ** 2).sum(1)
    small = rough < 2.0**62
    out = np.empty(len(x), object)
    if small.any():
        out[small] = ((whitening.n * y[small] - rest.astype(np.int64)) ** 2).sum(1)
    for k in np.flatnonzero(~small).tolist():
        total = sum((whitening.n * int(v) - r) ** 2 for v, r in zip(y[k].tolist(), rest.tolist(), strict=True))
        out[k] = total if total < 1 << 63 else None
    return out.tolist()


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per remaining row and component: ``key``, ``component``, ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    types = [T.IntegerType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType(), T.DoubleType()]
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *map(T.StructField, names, types)])
    rows = whole_vectors(df, key, vector)
    fit = written(rows.select("x").distinct(), "whitening-fit")
    whitening = fitted(fit, components)
    if whitening is None:
        return df.sparkSession.createDataFrame([], schema)
    error = identity_error(fit, whitening)
    explained = whitening.values / whitening.trace
    k = len(explained)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            each = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), whitening.n, np.int64)),
                    pa.array(_deviations(x, whitening), pa.int64()).take(pa.array(each)),
                    pa.array(whitening.whitened(x).reshape(-1)),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(each), error)),
                ],
                schema.fieldNames(),
            )

    return rows.mapInArrow(run, schema)


def op12_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their 16 largest components."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
