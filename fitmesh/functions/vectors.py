"""Feature vectors: one ``array<double>`` column, whatever its width."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NARROW = 64  # up to this width a projection is written as column expressions


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features", invalid: str = "error") -> DataFrame:
    """Ordered numeric columns as one array column.

    ``invalid``: ``error`` raises on the first null/NaN row, ``skip`` drops such
    rows, ``keep`` stores NaN.
    """
    values = [F.col(f"`{c}`").cast("double") for c in columns]
    meta = {"width": len(columns), "names": list(columns)}
    if invalid == "keep":
        return df.withColumn(out, F.array(*[F.coalesce(v, F.lit(float("nan"))) for v in values])).withMetadata(out, meta)
    if invalid not in ("skip", "error"):
        raise ValueError("invalid must be 'error', 'skip' or 'keep'")
    made = df.withColumn(out, F.array(*values))
    if len(values) <= NARROW:  # compiled with the scan
        bad = reduce(or_, [v.isNull() | F.isnan(v) for v in values], F.lit(False))
    else:
        bad = F.exists(out, lambda v: v.isNull() | F.isnan(v))  # one test of the array: plans stay flat at any width
    if invalid == "skip":
        return made.filter(~bad).withMetadata(out, meta)
    return made.withColumn(out, F.when(bad, F.raise_error(F.lit("null or NaN among the features"))).otherwise(F.col(out))).withMetadata(out, meta)


def as_array(df: DataFrame, column: str) -> Column:
    """The column as ``array<double>``; accepts ML vectors and numeric arrays."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, VectorUDT):
        return vector_to_array(F.col(column))
    if isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, T.DoubleType):
            return F.col(column)
        return F.col(column).cast("array<double>")
    raise TypeError(f"{column} must be an array or vector column, not {dtype.simpleString()}")


def exact_in_single(df: DataFrame, column: str) -> bool:
    """Whether the column holds single precision numbers: as such they travel at half the size."""
    dtype = df.schema[column].dataType
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.FloatType)


def as_vector(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, VectorUDT):
        return F.col(column)
    return array_to_vector(as_array(df, column))


def width(df: DataFrame, column: str) -> int:
    """Vector length, from column metadata or else from one row."""
    meta = df.schema[column].metadata or {}
    if "width" in meta:
        return int(meta["width"])
    row = df.select(F.size(as_array(df, column)).alias("n")).first()
    if row is None:
        raise ValueError("empty input")
    return int(row["n"])


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list<double> Arrow column as a 2-d array (no per-row objects)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def list_column(values: np.ndarray) -> pa.Array:
    """The inverse of :func:`matrix`."""
    rows, cols = values.shape
    offsets = np.arange(0, rows * cols + 1, cols, dtype=np.int32) if cols else np.zeros(rows + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values, np.float64).ravel()))


def map_rows(fn: Callable[[np.ndarray], np.ndarray], column: Column, returns: str = "double") -> Column:
    """Apply a NumPy function of a feature matrix to a vector column, batch by batch."""

    @F.arrow_udf(returns)
    def apply(col: pa.Array) -> pa.Array:
        if len(col) == 0:
            return pa.array([], type=pa.float64() if returns == "double" else pa.list_(pa.float64()))
        result = fn(matrix(col))
        return pa.array(result) if result.ndim == 1 else list_column(result)

    return apply(column)


def affine(column: Column, weights: np.ndarray, intercept: float, n: int) -> Column:
    """``x . w + b``: column arithmetic when narrow, one matrix product per batch when wide."""
    weights = np.asarray(weights, dtype=float)
    if n <= NARROW:
        out = F.lit(float(intercept))
        for i, w in enumerate(weights):
            if w != 0.0:
                out = out + column[i] * F.lit(float(w))
        return out
    return map_rows(lambda x: x @ weights + intercept, column)
