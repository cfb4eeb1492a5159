"""Row-space (dual) form for short, wide tables: an n x n Gram matrix instead of p x p."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.vectors import as_array, matrix
from fitmesh.operators.partials import reduce_arrays

DUAL_ROWS = 4096     # n x n stays at or below 128 MB
_BLOCK = 1024        # features per block


def use_dual(df: DataFrame, p: int) -> bool:
    """True when there are more features than rows and the row Gram matrix is small."""
    if p <= 512:
        return False
    n = df.limit(min(p, DUAL_ROWS + 1)).count()
    return n < p and n <= DUAL_ROWS


@dataclass
class DualGram:
    """Centred row Gram matrix ``K``, the label, and access to ``X^T a``."""

    rows: DataFrame
    features: str
    gram: np.ndarray
    y: np.ndarray
    mean: np.ndarray

    def back(self, coefficients: np.ndarray) -> np.ndarray:
        """``Xc^T A`` for an (n, k) matrix, block of columns by block of columns."""
        a = np.atleast_2d(coefficients.T).T
        a = a - a.mean(axis=0)  # centring of X moved to A
        p, k = len(self.mean), a.shape[1]
        cols = [as_array(self.rows, self.features).alias("x"), F.col("_i").alias("i")]

        def fold(batches):
            acc = np.zeros((p, k))
            for b in batches:
                acc += matrix(b.column("x")).T @ a[b.column("i").to_numpy(zero_copy_only=False)]
            return {"w": acc.ravel()}

        return reduce_arrays(self.rows.select(*cols), fold)["w"].reshape(p, k)

    def ridge(self, alpha: float) -> tuple[np.ndarray, float]:
        """Coefficients and intercept of the ridge fit (``alpha=0``: minimum norm)."""
        yc = self.y - self.y.mean()
        values, vectors = np.linalg.eigh(self.gram)
        keep = values > max(values.max(), 0.0) * len(values) * 1e-13
        v = vectors[:, keep]
        w = self.back(v @ ((v.T @ yc) / (values[keep] + alpha)))[:, 0]
        return w, float(self.y.mean() - self.mean @ w)


def dual_gram(df: DataFrame, features: str, label: str | None = None) -> DualGram:
    """Blocks of columns are multiplied on executors and summed; n is at most ``DUAL_ROWS``."""
    from fitmesh.session import durable

    label_col = F.col(label).cast("double") if label else F.lit(0.0)
    base = df.select(as_array(df, features).alias(features), label_col.alias("_y"))
    # ids are fixed by writing the (small) table once
    rows = durable(base.withColumn("_u", F.monotonically_increasing_id()))
    order = sorted(r["_u"] for r in rows.select("_u").limit(DUAL_ROWS + 1).collect())
    n = len(order)
    if n > DUAL_ROWS:
        raise ValueError(f"the dual form is limited to {DUAL_ROWS} rows")
    index = df.sparkSession.createDataFrame([(u, i) for i, u in enumerate(order)], "_u long, _i int")
    rows = rows.join(F.broadcast(index), "_u").drop("_u")
    labels = rows.select("_i", "_y").toPandas().sort_values("_i")["_y"].to_numpy(float)
    blocks = rows.select(F.col("_i"), F.posexplode(
        F.transform(F.sequence(F.lit(0), (F.ceil(F.size(features) / _BLOCK) - 1).cast("int")),
                    lambda b: F.slice(F.col(features), b * _BLOCK + 1, _BLOCK))).alias("_b", "_x"))

    def multiply(key, table):
        x = matrix(table.column("_x"))
        i = table.column("_i").to_numpy()
        full = np.zeros((n, x.shape[1]))
        full[i] = x
        mu = full.mean(axis=0)
        full -= mu
        k = (full @ full.T).ravel()
        return pa.table({"_b": pa.array([key[0].as_py()], pa.int32()), "mu": [mu], "k": [k]})

    parts = durable(blocks.groupBy("_b").applyInArrow(multiply, "_b int, mu array<double>, k array<double>"))
    gram = reduce_arrays(parts.select("k"), lambda bs: {"k": sum((matrix(b.column("k")).sum(axis=0) for b in bs if b.num_rows),
                                                               np.zeros(n * n))})["k"].reshape(n, n)
    mean = np.concatenate([np.array(r["mu"]) for r in sorted(parts.select("_b", "mu").collect(), key=lambda r: r["_b"])])
    return DualGram(rows.withColumnRenamed("_y", "_label"), features, gram, labels, mean)
