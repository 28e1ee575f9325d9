"""Whitening of vectors by the leading components of their covariance.

Sums and centred products are gathered by Spark in two passes over all vectors, a few numbers a task; the driver gets one
matrix of dimensions x dimensions (meant for up to about a thousand), slices its spectrum, and a third pass projects.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.llm.spectrum import leading
from newsgraph.scratch import materialise

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
# Entries are held within this bound before they become integers; no vector of a model comes near it.
MOST = 2.0**50
_LOW = (1 << 32) - 1
_LONG = 1 << 63


def _steps(vector: Column) -> Column:
    """floor(1024 c) + 100000 of every entry."""
    held = lambda c: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), c.cast("double")))
    return F.transform(vector, lambda c: F.floor(held(c) * SCALE) + F.lit(OFFSET).cast("long"))


def _matrices(batches: Iterator[pa.RecordBatch], at: int, size: int, rows: int = 8192) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches with their vectors as a matrix of 64-bit integers."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield part, part.column(at).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, size)


def _sums(steps: DataFrame, size: int, total: int) -> list[int]:
    """Exact sums of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for _, x in _matrices(batches, 0, size):
            high += (x >> 32).sum(axis=0)
            low += (x & _LOW).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(high), pa.array(low)], names=["at", "high", "low"])

    parts = steps.select("x").mapInArrow(run, "at int, high long, low long")
    found = parts.groupBy("at").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    out = [0] * size
    for r in found.collect():  # a row for each dimension
        out[r["at"]] = (int(r["high"]) << 32) + int(r["low"])
    return out


def _covariance(steps: DataFrame, size: int, total: int, whole: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Covariance, divisor `total`, of vectors centred by whole + part."""
    rows, columns = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, seen = np.zeros((size, size)), False
        for _, x in _matrices(batches, 0, size):
            centred = (x - whole).astype(np.float64) - part
            products += centred.T @ centred
            seen = True
        if seen:
            values = [pa.array(rows.astype(np.int32)), pa.array(columns.astype(np.int32)), pa.array(products[rows, columns])]
            yield pa.RecordBatch.from_arrays(values, names=["i", "j", "v"])

    parts = steps.select("x").mapInArrow(run, "i int, j int, v double")
    found = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()  # half a matrix
    i, j, v = (found.column(c).to_numpy() for c in ("i", "j", "v"))
    out = np.zeros((size, size))
    out[i, j] = out[j, i] = v / total
    return out


def _deviations(x: np.ndarray, whole: np.ndarray, rest: np.ndarray, total: int) -> list[int | None]:
    """Exact sums over dimensions of (total * x - S)^2, where S = total * whole + rest; null beyond a long."""
    y = x - whole
    largest = int(np.abs(y).max(initial=0)) + 1
    if x.shape[1] * (total * largest) ** 2 < _LONG:
        return ((total * y - rest) ** 2).sum(axis=1).tolist()
    exact = ((total * y.astype(object) - rest.astype(object)) ** 2).sum(axis=1)
    return [int(v) if v < _LONG else None for v in exact]


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained, eigenvalue, identity_error, a row for each vector and component.

    Vectors that are null or hold null or non-finite entries are dropped; all others are fitted and returned, repeated rows
    and rows with a null key too. Entries c become floor(1024 c) + 100000 (c held within +-2^50). Shorter vectors count as
    if zeros followed. There are at most `components` components: those with an eigenvalue above 1e-12 of the trace, so
    vectors without variance give no rows, nor does an empty table. A deviation beyond a long is null. Equal eigenvalues
    get any orthonormal basis of their space, the same for all rows. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    usable = F.col(vector).isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(key).alias("key"), _steps(F.col(vector)).alias("x"))
    kept = materialise(kept, "steps")
    about = kept.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("x")), F.lit(0)).alias("size")).first()
    total, size = about["n"], about["size"]
    kind = vectors.schema[key].dataType
    if size:
        zeros = F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(size) - F.size("x"))
        steps = kept.withColumn("x", F.concat("x", zeros))
        sums = _sums(steps, size, total)
        whole = np.array([s // total for s in sums], dtype=np.int64)
        rest = np.array([s % total for s in sums], dtype=np.int64)
        part = np.array([float(Fraction(int(r), total)) for r in rest])
        covariance = _covariance(steps, size, total, whole, part)
        values, axes = leading(covariance, components)
    if not size or not len(values):
        return spark.createDataFrame([], T.StructType([
            T.StructField(key, kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            *[T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "eigenvalue", "identity_error")],
        ]))
    scaled = (axes / np.sqrt(values)[:, None]).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(batches, 1, size):
            found = ((x - whole).astype(np.float64) - part) @ scaled
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.reshape(-1)), found.shape[1]).cast(pa.list_(pa.float64()))
            deviations = pa.array(_deviations(x, whole, rest, total), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), deviations, lists], names=["key", "deviation", "whitened"])

    schema = T.StructType([T.StructField("key", kind), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    projected = materialise(steps.select("key", "x").mapInArrow(run, schema), "whitened")
    error = identity_error(projected, len(values))
    explained = F.array(*[F.lit(float(v / np.trace(covariance))) for v in values])
    eigenvalues = F.array(*[F.lit(float(v)) for v in values])
    return projected.select(F.col("key").alias(key), "deviation", F.posexplode("whitened").alias("_at", "_value")).select(
        key, (F.col("_at") + 1).alias("component"), F.lit(total).cast("long").alias("n"), "deviation", F.col("_value").alias("whitened"),
        F.get(explained, F.col("_at")).alias("explained"), F.get(eigenvalues, F.col("_at")).alias("eigenvalue"), F.lit(error).alias("identity_error"),
    )


def identity_error(projected: DataFrame, size: int) -> float:
    """Largest absolute entry of the covariance of `whitened` (lists of `size` numbers) less the identity."""
    at = [F.col("whitened")[i] for i in range(size)]
    means = projected.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(at)]).first()
    centred = [c - F.lit(means[i]) for i, c in enumerate(at)]
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    found = projected.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(math.fabs(found[k] - (i == j)) for k, (i, j) in enumerate(pairs))
