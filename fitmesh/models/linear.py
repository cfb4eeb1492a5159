"""Least-squares family. Each fit is one aggregation plus a small solve on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.ml.param import TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.vectors import affine, as_array, matrix, width
from fitmesh.models.base import RegressionModel, Regressor, param
from fitmesh.operators.dual import dual_gram, use_dual
from fitmesh.operators.stats import Moments, moments


class LinearModel(RegressionModel):
    """``prediction = x . coefficients + intercept``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        x = as_array(df, self.getFeaturesCol())
        w = np.atleast_1d(self.state["coefficients"])
        return df.withColumn(self.getPredictionCol(), affine(x, w, float(self.state["intercept"]), len(w)))


class LinearRegressor(Regressor):
    """A linear model solved from :class:`Moments`; subclasses give the penalty."""

    MODEL = LinearModel

    def solve(self, m: Moments) -> tuple[np.ndarray, float]:
        """Coefficients and intercept from the moments of ``(x, y)``."""
        s, mean = m.scatter, m.mean
        p = len(mean) - 1
        w = self.coefficients(s[:p, :p], s[:p, p], m.n)
        return w, float(mean[p] - mean[:p] @ w)

    def coefficients(self, gram: np.ndarray, xty: np.ndarray, n: float) -> np.ndarray:
        raise NotImplementedError

    def dual_penalty(self) -> float | None:
        """The L2 penalty when the fit also has a row-space form, else ``None``."""
        return None

    def _fit(self, df: DataFrame) -> LinearModel:
        features, label = self.getFeaturesCol(), self.getLabelCol()
        penalty = self.dual_penalty()
        if penalty is not None and use_dual(df, width(df, features)):
            w, b = dual_gram(df, features, label).ridge(penalty)
        else:
            w, b = self.solve(moments(df, features, label))
        return self._hand_over(self.MODEL(state={"coefficients": w, "intercept": b}))


class OLS(LinearRegressor):
    """Ordinary least squares; the minimum-norm solution when columns are dependent."""

    def coefficients(self, gram, xty, n):
        return min_norm_solve(gram, xty)

    def dual_penalty(self):
        return 0.0


class Ridge(LinearRegressor):
    """Minimises ``|y - Xw|^2 + alpha |w|^2``; the intercept is not penalised."""

    alpha = param("alpha", "L2 penalty", TypeConverters.toFloat)
    DEFAULTS = {"alpha": 1.0}

    def coefficients(self, gram, xty, n):
        return min_norm_solve(gram + self.get("alpha") * np.eye(len(xty)), xty)

    def dual_penalty(self):
        return self.get("alpha")


class ElasticNet(LinearRegressor):
    """Minimises ``|y - Xw|^2/(2n) + alpha l1_ratio |w|_1 + alpha (1-l1_ratio) |w|^2/2``."""

    alpha = param("alpha", "penalty strength", TypeConverters.toFloat)
    l1_ratio = param("l1_ratio", "share of the L1 penalty", TypeConverters.toFloat)
    max_iter = param("max_iter", "coordinate sweeps", TypeConverters.toInt)
    DEFAULTS = {"alpha": 1.0, "l1_ratio": 0.5, "max_iter": 1000}

    def coefficients(self, gram, xty, n):
        alpha, ratio = self.get("alpha"), self.get("l1_ratio")
        return coordinate_descent(gram / n, xty / n, alpha * ratio, alpha * (1.0 - ratio), self.get("max_iter"))


class Lasso(LinearRegressor):
    """Minimises ``|y - Xw|^2/(2n) + alpha |w|_1``."""

    alpha = param("alpha", "L1 penalty", TypeConverters.toFloat)
    max_iter = param("max_iter", "coordinate sweeps", TypeConverters.toInt)
    DEFAULTS = {"alpha": 1.0, "max_iter": 1000}

    def coefficients(self, gram, xty, n):
        return coordinate_descent(gram / n, xty / n, self.get("alpha"), 0.0, self.get("max_iter"))


def min_norm_solve(gram: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Symmetric solve after diagonal scaling; null directions get no weight."""
    d = np.sqrt(np.clip(np.diag(gram), 0.0, None))
    if not np.any(d > 0):
        return np.zeros(len(rhs))
    live = d > d.max() * 1e-12
    g, r, s = gram[np.ix_(live, live)], rhs[live], d[live]
    scaled = g / np.outer(s, s)
    values, vectors = np.linalg.eigh((scaled + scaled.T) / 2)
    keep = values > values.max() * len(values) * 1e-13
    out = np.zeros(len(rhs))
    if keep.all():
        out[live] = vectors @ ((vectors.T @ (r / s)) / values) / s
        return out
    # rank deficient: the shortest w in the original scale
    values, vectors = np.linalg.eigh((g + g.T) / 2)
    keep = values > values.max() * len(values) * 1e-13
    v = vectors[:, keep]
    out[live] = v @ ((v.T @ r) / values[keep])
    return out


def coordinate_descent(gram: np.ndarray, xty: np.ndarray, l1: float, l2: float, max_iter: int, tol: float = 1e-12) -> np.ndarray:
    """Cyclic coordinate descent on the normal equations."""
    w = np.zeros(len(xty))
    grad = xty.copy()  # xty - gram w
    diag = np.diag(gram)
    for _ in range(max_iter):
        largest = 0.0
        for j in np.flatnonzero(diag > 0):
            rho = grad[j] + diag[j] * w[j]
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (diag[j] + l2)
            step = new - w[j]
            if step != 0.0:
                grad -= gram[:, j] * step
                w[j] = new
                largest = max(largest, abs(step) * np.sqrt(diag[j]))
        if largest <= tol * max(1.0, np.sqrt(diag.max(initial=0.0)) * np.abs(w).max(initial=0.0)):
            break
    return w
