"""Repeated k-fold cross-validation.

The least-squares family is fitted for all folds of all repeats from one scan
(train = total - fold) and scored in a second one. Other families are refitted
per fold, with the fits submitted side by side and scored in one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.metrics import cv_summary, fold_scores
from fitmesh.functions.vectors import NARROW, as_array
from fitmesh.models.linear import LinearRegressor
from fitmesh.operators.reduce import PCA
from fitmesh.operators.scale import StandardScale
from fitmesh.operators.stats import Moments, fold_moments
from fitmesh.plans.parallel import run_all
from fitmesh.session import holding


def moment_solver(estimator):
    """``solve(moments)`` in input space when the estimator can be fitted from sums alone, else ``None``.

    Covers the least-squares family, also behind standard scaling and principal
    components: both are affine maps that the moments determine.
    """
    steps = getattr(estimator, "steps", [])
    regressor = getattr(estimator, "regressor", estimator)
    if not isinstance(regressor, LinearRegressor) or not all(type(s) in (StandardScale, PCA) for s in steps):
        return None

    def solve(m: Moments) -> tuple[np.ndarray, float]:
        p = len(m.mean) - 1
        a, c = np.eye(p), np.zeros(p)  # prepared features are a x + c
        mean, scatter = m.mean, m.scatter
        for step in steps:
            step_a, step_c = step.from_moments(m.n, mean[:-1], scatter[:-1, :-1])
            a, c = step_a @ a, step_a @ c + step_c
            lift = np.zeros((len(step_a) + 1, len(mean)))
            lift[:-1, :-1], lift[-1, -1] = step_a, 1.0
            mean = lift @ mean + np.append(step_c, 0.0)
            scatter = lift @ scatter @ lift.T
        w, b = regressor.solve(Moments(m.n, np.zeros(len(mean)), scatter, mean))
        return a.T @ w, float(b + w @ c)

    return solve if steps else regressor.solve


def linear_fold_fits(estimator, df: DataFrame, fold_columns: Sequence[str],
                     folds: list[dict[int, Moments]] | None = None) -> list[dict[int, tuple[np.ndarray, float]]]:
    """Coefficients and intercept of every (repeat, held-out fold), from one pass."""
    solve, fits = moment_solver(estimator), []
    for cells in folds or fold_moments(df, features_of(estimator), estimator.getOrDefault("labelCol"), fold_columns):
        total = reduce(lambda a, b: a + b, cells.values())
        fits.append({f: solve(total - m) for f, m in cells.items() if total.n > m.n})
    return fits


def features_of(estimator) -> str:
    return getattr(estimator, "regressor", estimator).getOrDefault("featuresCol")


def fold_prediction(x: Column, fold: Column, fits: dict[int, tuple[np.ndarray, float]]) -> Column:
    """The held-out prediction: coefficients are picked by the row's fold, then one dot product."""
    width = len(next(iter(fits.values()))[0])
    folds = sorted(fits)
    if width <= NARROW:
        pick = lambda values: F.element_at(
            F.create_map(*[F.lit(v) for f, w in zip(folds, values) for v in (int(f), float(w))]), fold)
        out = pick([fits[f][1] for f in folds])
        for j in range(width):
            out = out + x[j] * pick([fits[f][0][j] for f in folds])
        return out
    table = np.array([fits[f][0] for f in folds])
    shift = np.array([fits[f][1] for f in folds])
    position = {f: i for i, f in enumerate(folds)}

    import pyarrow as pa

    from fitmesh.functions.vectors import matrix

    @F.arrow_udf("double")
    def predict(xs: pa.Array, fs: pa.Array) -> pa.Array:
        i = np.array([position[f] for f in fs.to_pylist()], dtype=int)
        scores = matrix(xs) @ table.T + shift if len(i) else np.zeros((0, len(folds)))
        return pa.array(scores[np.arange(len(i)), i])

    return predict(x, fold)


def linear_out_of_fold(estimator, df: DataFrame, fold_columns: Sequence[str],
                       keep: Sequence[str] = ()) -> DataFrame:
    """Long out-of-fold predictions ``(keep..., label, repeat, fold, prediction)`` of a least-squares model."""
    fits = linear_fold_fits(estimator, df, fold_columns)
    x = as_array(df, features_of(estimator))
    preds = {f"_p{r}": fold_prediction(x, F.col(c), fits[r]) for r, c in enumerate(fold_columns)}
    wide = df.select(*keep, F.col(estimator.getOrDefault("labelCol")).alias("label"), *fold_columns,
                     *[e.alias(k) for k, e in preds.items()])
    pairs = ", ".join(f"{r}, `{c}`, _p{r}" for r, c in enumerate(fold_columns))
    return wide.select(*keep, "label", F.expr(f"stack({len(fold_columns)}, {pairs}) as (repeat, fold, prediction)"))


def out_of_fold(estimator, df: DataFrame, fold_columns: Sequence[str], keep: Sequence[str] = (),
                parallelism: int = 4, keep_models: dict | None = None) -> DataFrame:
    """Long out-of-fold predictions of any estimator; every fold is refitted on its own training rows."""
    if keep_models is None and moment_solver(estimator) is not None:
        return linear_out_of_fold(estimator, df, fold_columns, keep)
    label = estimator.getOrDefault("labelCol")
    prediction = estimator.getOrDefault("predictionCol")
    folds = {c: sorted(r[0] for r in df.select(c).distinct().collect()) for c in fold_columns}
    tasks = [(r, c, f) for r, c in enumerate(fold_columns) for f in folds[c]]

    def fit(task):
        r, c, f = task
        model = estimator.fit(df.filter(F.col(c) != f))
        if keep_models is not None:
            keep_models[(r, f)] = model
        return model.transform(df.filter(F.col(c) == f)).select(
            *keep, F.col(label).alias("label"), F.lit(r).alias("repeat"), F.col(c).alias("fold"),
            F.col(prediction).alias("prediction"))

    return reduce(DataFrame.unionAll, run_all([lambda t=t: fit(t) for t in tasks], parallelism))


def cross_validate(estimator, df: DataFrame, fold_columns: Sequence[str], name: str | None = None,
                   parallelism: int = 4) -> DataFrame:
    """R2, RMSE and MAE of every (repeat, fold)."""
    name = name or type(estimator).__name__
    if moment_solver(estimator) is not None:
        return fold_scores(out_of_fold(estimator, df, fold_columns).withColumn("model", F.lit(name)))
    with holding(df) as data:  # read once per fold by the fits and once by the scoring
        return _materialised(out_of_fold(estimator, data, fold_columns, parallelism=parallelism), name)


def _materialised(long: DataFrame, name: str) -> DataFrame:
    """Fold scores as a local table: one row per (repeat, fold)."""
    scores = fold_scores(long.withColumn("model", F.lit(name)))
    return long.sparkSession.createDataFrame(scores.collect(), scores.schema)


def cross_validate_summary(estimator, df: DataFrame, fold_columns: Sequence[str], name: str | None = None,
                           parallelism: int = 4) -> DataFrame:
    return cv_summary(cross_validate(estimator, df, fold_columns, name, parallelism))


def cross_validate_keep_best(estimator, df: DataFrame, fold_columns: Sequence[str], parallelism: int = 4):
    """Refit per fold and return ``(best fold model, scores)``; best is the highest R2, first fold on ties."""
    models: dict = {}
    with holding(df) as data:
        long = out_of_fold(estimator, data, fold_columns, parallelism=parallelism, keep_models=models)
        scores = _materialised(long, type(estimator).__name__)
    rows = sorted(scores.collect(), key=lambda r: (r["repeat"], r["fold"]))
    best = None
    for r in rows:
        if r["r2"] == r["r2"] and (best is None or r["r2"] > best["r2"]):
            best = r
    if best is None:
        raise RuntimeError("no fold produced a score")
    return models[(best["repeat"], best["fold"])], scores
