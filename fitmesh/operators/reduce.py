"""Principal components from one distributed cross-product pass."""

from __future__ import annotations

import numpy as np
from pyspark.ml.param import TypeConverters
from pyspark.sql import DataFrame

from fitmesh.functions.vectors import affine, as_array, map_rows, matrix, width
from fitmesh.models.base import param
from fitmesh.operators.dual import dual_gram, use_dual
from fitmesh.operators.partials import MAX_STATE_BYTES, reduce_arrays
from fitmesh.operators.scale import Transformer_, VectorModel
from fitmesh.operators.stats import MAX_WIDTH, moments, provisional_shift


FIRST_AXES = 48  # axes that a wide table is first searched for when a share of variance is asked for


def fix_signs(components: np.ndarray) -> np.ndarray:
    """Each component's largest absolute loading is positive."""
    top = np.argmax(np.abs(components), axis=1)
    signs = np.sign(components[np.arange(len(components)), top])
    return components * np.where(signs == 0, 1.0, signs)[:, None]


def choose_k(ratio: np.ndarray, n_components: int | None, variance: float | None, limit: int) -> int:
    if variance is not None:
        if not 0.0 < variance < 1.0:
            raise ValueError("variance must lie between 0 and 1")
        # smallest k whose cumulative share exceeds the fraction
        return int(min(np.searchsorted(np.cumsum(ratio), variance, side="right") + 1, limit))
    k = limit if n_components is None else n_components
    if not 1 <= k <= limit:
        raise ValueError(f"n_components={k} must be between 1 and min(n, p)={limit}")
    return k


def principal_axes(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (descending, never negative) and components as rows."""
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(values)[::-1]
    return np.clip(values[order], 0.0, None), fix_signs(vectors[:, order].T)


def wide_axes(df: DataFrame, column: str, p: int, n_components: int | None, variance: float | None,
              passes: int = 30, tol: float = 1e-9) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(components, shares, mean)`` of the leading axes without the p x p matrix: block subspace iteration.

    A pass adds up ``X^T (X Q)`` for an orthonormal p x (k + 16) block Q, so a task holds two such blocks. Passes end when the
    kept eigenvalues move by less than ``tol`` of the first one, or at ``passes``. With ``variance`` the block doubles until the kept axes exceed the share.
    """
    shift = provisional_shift(df, column, None, p)[:p]
    rows = df.select(as_array(df, column).alias("x"))

    def sums(batches):
        acc = np.zeros(2 + p)
        for b in batches:
            z = matrix(b.column("x"))
            if len(z):
                z = z - shift
                acc[0] += len(z)
                acc[1] += (z * z).sum()
                acc[2:] += z.sum(axis=0)
        return {"s": acc}

    s = reduce_arrays(rows, sums)["s"]
    n, mean = s[0], shift + s[2:] / s[0]
    trace = s[1] - (s[2:] ** 2).sum() / n
    limit = int(min(n, p))
    if variance is not None:
        choose_k(np.zeros(limit), None, variance, limit)  # refuses a wrong share before the passes
    k = choose_k(np.zeros(limit), n_components, None, limit) if variance is None else min(FIRST_AXES, limit)
    rng = np.random.default_rng(0)
    q = np.zeros((p, 0))
    while True:
        size = min(k + 16, limit)
        if 2 * 8 * p * size > MAX_STATE_BYTES:
            raise ValueError(f"{size} axes of {p} features do not fit a task; ask for fewer components")
        q = np.linalg.qr(np.column_stack([q, rng.standard_normal((p, size - q.shape[1]))]))[0]
        before = None
        for _ in range(passes):
            def products(batches, q=q):
                acc = np.zeros(q.shape)
                for b in batches:
                    z = matrix(b.column("x"))
                    if len(z):
                        z = z - mean
                        acc += z.T @ (z @ q)
                return {"y": acc}

            y = reduce_arrays(rows, products)["y"].reshape(q.shape)
            values, turn = np.linalg.eigh((q.T @ y + y.T @ q) / 2)
            order = np.argsort(values)[::-1]
            values, axes = np.clip(values[order], 0.0, None), q @ turn[:, order]
            if before is not None and np.abs(values[:k] - before).max() <= tol * max(values[0], 1e-300):
                break
            before = values[:k]
            q = np.linalg.qr(y)[0]
        share = values / trace if trace > 0 else np.zeros(len(values))
        if variance is None:
            break
        if share[:k].sum() > variance or k == limit:
            k = choose_k(share[:k], None, variance, k)
            break
        q, k = axes, min(2 * k, limit)
    return fix_signs(axes[:, :k].T), share[:k], mean


class PCAModel(VectorModel):
    """Centred projection ``(x - mean) W^T``."""

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.sql import functions as F

        w, mean = np.atleast_2d(self.state["components"]), np.atleast_1d(self.state["mean"])
        x = as_array(df, self.getInputCol())
        k, p = w.shape
        if k * p <= 64:
            column = F.array(*[affine(x, w[i], -float(w[i] @ mean), p) for i in range(k)])
        else:
            column = map_rows(lambda m: (m - mean) @ w.T, x, "array<double>")
        return self._put(df, column, k)

    def explained_variance_ratio(self, spark) -> DataFrame:
        """``(component, ratio, cumulative)`` of the kept components."""
        ratio = np.atleast_1d(self.state["ratio"])
        total = np.cumsum(ratio)
        return spark.createDataFrame([(i + 1, float(r), float(c)) for i, (r, c) in enumerate(zip(ratio, total))],
                                     "component int, ratio double, cumulative double")


class PCA(Transformer_):
    """Top components by count (``n_components``) or by explained share (``variance``)."""

    n_components = param("n_components", "components to keep")
    variance = param("variance", "share of variance to exceed")
    DEFAULTS = {"n_components": None, "variance": None}

    def _fit(self, df: DataFrame) -> PCAModel:
        column = self.getInputCol()
        p = width(df, column)
        if use_dual(df, p):
            d = dual_gram(df, column)
            n, mean = len(d.y), d.mean
            values, vectors = np.linalg.eigh(d.gram)
            order = np.argsort(values)[::-1]
            values, vectors = np.clip(values[order], 0.0, None), vectors[:, order]
            ratio = values / values.sum() if values.sum() > 0 else np.zeros(len(values))
            k = choose_k(ratio, self.get("n_components"), self.get("variance"), min(n, p))
            live = np.where(values[:k] > values[0] * n * 1e-13, values[:k], np.inf)
            components = fix_signs((d.back(vectors[:, :k]) / np.sqrt(live)).T)
        elif p > MAX_WIDTH:
            components, ratio, mean = wide_axes(df, column, p, self.get("n_components"), self.get("variance"))
            k = len(components)
        else:
            m = moments(df, column)
            mean = m.mean[:p]
            components, ratio = self.solve(m.n, m.scatter[:p, :p])
            k = len(components)
        return self._hand_over(PCAModel({"components": components, "mean": mean, "ratio": ratio[:k]}))

    def solve(self, n: float, scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values, components = principal_axes(scatter / max(n - 1, 1))
        ratio = values / values.sum() if values.sum() > 0 else np.zeros(len(values))
        k = choose_k(ratio, self.get("n_components"), self.get("variance"), int(min(n, len(values))))
        return components[:k], ratio

    def from_moments(self, n: float, mean: np.ndarray, scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The fitted map ``a x + c`` from a mean and centred cross products."""
        components, _ = self.solve(n, scatter)
        return components, -components @ mean
