"""Scalers over a vector column: standard, robust, quantile."""

from __future__ import annotations

import numpy as np
from pyspark.ml.base import Estimator
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.vectors import NARROW, as_array, map_rows, width
from fitmesh.models.base import Configurable, StateModel, param
from fitmesh.operators.orderstats import interpolate, order_statistics, quantiles
from fitmesh.operators.partials import reduce_arrays
from fitmesh.operators.stats import provisional_shift


class Transformer_(Configurable, HasInputCol, HasOutputCol, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Base of vector-to-vector estimators; ``outputCol`` may equal ``inputCol``."""

    BASE = {"inputCol": "features", "outputCol": "features"}

    def __init__(self, **values):
        super().__init__(**values)
        self._setDefault(**self.BASE)

    def _hand_over(self, model):
        return self._copyValues(model)


class VectorModel(StateModel, HasInputCol, HasOutputCol):
    def __init__(self, state=None, **values):
        super().__init__(state, **values)
        self._setDefault(inputCol="features", outputCol="features")

    def _put(self, df: DataFrame, column, n: int) -> DataFrame:
        out = self.getOutputCol()
        return df.withColumn(out, column).withMetadata(out, {"width": n})


class LinearMapModel(VectorModel):
    """``(x - centre) / scale`` per element; entries with scale 1 pass unscaled."""

    def _transform(self, df: DataFrame) -> DataFrame:
        centre, scale = np.atleast_1d(self.state["centre"]), np.atleast_1d(self.state["scale"])
        x = as_array(df, self.getInputCol())
        if len(centre) <= NARROW:
            column = F.array(*[(x[i] - F.lit(float(c))) / F.lit(float(s)) for i, (c, s) in enumerate(zip(centre, scale))])
        else:
            column = map_rows(lambda m: (m - centre) / scale, x, "array<double>")
        return self._put(df, column, len(centre))


def mean_and_std(df: DataFrame, column: str) -> tuple[float, np.ndarray, np.ndarray]:
    """Row count, means and population standard deviations of a vector column in one pass."""
    n = width(df, column)
    x = as_array(df, column)
    if n <= NARROW // 2:
        aggs = [F.count(F.lit(1)).alias("n")]
        for i in range(n):
            aggs += [F.avg(x[i]).alias(f"m{i}"), F.stddev_pop(x[i]).alias(f"s{i}")]
        r = df.agg(*aggs).first()
        if not r["n"]:
            raise ValueError("empty input")
        return float(r["n"]), np.array([r[f"m{i}"] for i in range(n)], float), np.array([r[f"s{i}"] for i in range(n)], float)
    from fitmesh.functions.vectors import matrix

    shift = provisional_shift(df, column, None, n)[:n]

    def fold(batches):
        acc = np.zeros(1 + 2 * n)
        for b in batches:
            z = matrix(b.column("x"))
            if len(z):
                z = z - shift
                acc[0] += len(z)
                acc[1:1 + n] += z.sum(axis=0)
                acc[1 + n:] += np.einsum("ij,ij->j", z, z)
        return {"m": acc}

    acc = reduce_arrays(df.select(x.alias("x")), fold)["m"]
    mean = acc[1:1 + n] / acc[0]
    var = np.clip(acc[1 + n:] / acc[0] - mean * mean, 0.0, None)
    return acc[0], mean + shift, np.sqrt(var)


def divisor(mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    """The std, or 1 where it is zero up to rounding."""
    return np.where(std <= 10 * np.finfo(float).eps * np.abs(mean), 1.0, std)


class StandardScale(Transformer_):
    """``(x - mean) / std`` with the population std; a constant element becomes 0."""

    def _fit(self, df: DataFrame) -> LinearMapModel:
        _, mean, std = mean_and_std(df, self.getInputCol())
        return self._hand_over(LinearMapModel({"centre": mean, "scale": divisor(mean, std)}))

    def from_moments(self, n: float, mean: np.ndarray, scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The fitted map ``a x + c`` from a mean and centred cross products."""
        scale = divisor(mean, np.sqrt(np.clip(np.diag(scatter) / n, 0.0, None)))
        return np.diag(1.0 / scale), -mean / scale


_COLUMN_CHUNK = 64  # vector elements per order-statistics job


def _element_frames(df: DataFrame, column: str):
    n = width(df, column)
    x = as_array(df, column)
    for start in range(0, n, _COLUMN_CHUNK):
        names = [f"x{i}" for i in range(start, min(n, start + _COLUMN_CHUNK))]
        yield df.select(*[x[i].alias(f"x{i}") for i in range(start, start + len(names))]), names


class RobustScale(Transformer_):
    """``(x - median) / (q_hi - q_lo)`` with exact interpolated quantiles; a zero range divides by 1."""

    quantile_range = param("quantile_range", "lower and upper percentile", TypeConverters.toListFloat)
    DEFAULTS = {"quantile_range": [25.0, 75.0]}

    def _fit(self, df: DataFrame) -> LinearMapModel:
        lo, hi = self.get("quantile_range")
        centre, scale = [], []
        for frame, names in _element_frames(df, self.getInputCol()):
            q = quantiles(frame, names, [lo / 100.0, 0.5, hi / 100.0])
            centre += [q[c][1] for c in names]
            scale += [q[c][2] - q[c][0] for c in names]
        scale = np.array(scale)
        return self._hand_over(LinearMapModel({"centre": np.array(centre), "scale": np.where(scale == 0, 1.0, scale)}))


class QuantileTransformModel(VectorModel):
    output = param("output", "uniform or normal")

    def _transform(self, df: DataFrame) -> DataFrame:
        grid, refs = np.atleast_2d(self.state["grid"]), self.state["references"]
        normal = self.get("output") == "normal"

        def apply(m):
            out = np.empty_like(m)
            for j in range(m.shape[1]):
                # ties in the grid: average of the right-hand and left-hand interpolation
                up = np.interp(m[:, j], grid[j], refs)
                down = -np.interp(-m[:, j], -grid[j][::-1], -refs[::-1])
                u = 0.5 * (up + down)
                u[m[:, j] >= grid[j][-1]] = 1.0
                u[m[:, j] <= grid[j][0]] = 0.0
                out[:, j] = u
            return normal_ppf(out) if normal else out

        return self._put(df, map_rows(apply, as_array(df, self.getInputCol()), "array<double>"), len(grid))


class QuantileTransform(Transformer_):
    """Piecewise-linear map through the empirical quantile grid to [0, 1] or to a normal scale. No subsampling."""

    n_quantiles = param("n_quantiles", "grid points", TypeConverters.toInt)
    output = param("output", "uniform or normal")
    DEFAULTS = {"n_quantiles": 1000, "output": "uniform"}

    def _fit(self, df: DataFrame) -> QuantileTransformModel:
        if self.get("output") not in ("uniform", "normal"):
            raise ValueError("output must be 'uniform' or 'normal'")
        limit = self.get("n_quantiles")
        grids, refs = [], None

        def positions(_, n):
            m = max(2, min(limit, n))
            at = np.linspace(0.0, 1.0, m) * (n - 1)
            return np.concatenate([np.floor(at), np.ceil(at)]).astype(np.int64)

        for frame, names in _element_frames(df, self.getInputCol()):
            totals, found = order_statistics(frame, names, positions)
            for c in names:
                if totals[c] == 0:
                    raise ValueError("empty input")
                refs = np.linspace(0.0, 1.0, max(2, min(limit, totals[c])))
                grids.append(np.maximum.accumulate(interpolate(found[c], refs * (totals[c] - 1))))
        model = QuantileTransformModel({"grid": np.array(grids), "references": refs}, output=self.get("output"))
        return self._hand_over(model)


def normal_ppf(u: np.ndarray) -> np.ndarray:
    """Inverse normal CDF, clipped just inside (0, 1)."""
    from statistics import NormalDist

    # fixed value: probabilities are clipped this close to 0 and 1
    edge = 1e-7
    low, high = NormalDist().inv_cdf(edge - np.spacing(1)), NormalDist().inv_cdf(1 - (edge - np.spacing(1)))
    u = np.clip(u, 1e-12, 1 - 1e-12)
    z = _ppf(u)
    return np.clip(z, low, high)


def _ppf(u: np.ndarray) -> np.ndarray:
    """Newton steps on the normal CDF from a logistic start; converges to double precision."""
    from math import erfc

    cdf = np.frompyfunc(lambda t: 0.5 * erfc(-t / 2 ** 0.5), 1, 1)
    tail = np.minimum(u, 1 - u)  # solve in the lower half, where erfc keeps relative precision
    t = np.sqrt(-2.0 * np.log(tail))
    z = -(t - (2.30753 + 0.27061 * t) / (1.0 + 0.99229 * t + 0.04481 * t * t))
    for _ in range(6):
        c = cdf(z).astype(float)
        pdf = np.exp(-0.5 * z * z) / np.sqrt(2 * np.pi)
        step = (c - tail) / pdf
        z = z - step / (1.0 + 0.5 * z * step)
    return np.where(u < 0.5, z, -z)
