"""Regression metrics as aggregate expressions: every score is one ``agg``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("r2", "neg_mean_squared_error", "neg_mean_absolute_error")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r2(y: Column | str, p: Column | str) -> Column:
    """1 - SSE/SST; a constant label scores 1.0 when exact and 0.0 otherwise; NaN below two rows."""
    y, p = _c(y), _c(p)
    sse = F.sum(F.pow(y - p, 2))
    sst = F.count(y) * F.var_pop(y)
    return (
        F.when(F.count(y) < 2, F.lit(float("nan")))
        .when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0))
        .otherwise(1.0 - sse / sst)
    )


def mse(y: Column | str, p: Column | str) -> Column:
    return F.avg(F.pow(_c(y) - _c(p), 2))


def rmse(y: Column | str, p: Column | str) -> Column:
    return F.sqrt(mse(y, p))


def mae(y: Column | str, p: Column | str) -> Column:
    return F.avg(F.abs(_c(y) - _c(p)))


def weighted_r2(y: Column | str, p: Column | str, w: Column | str, shift: float = 0.0) -> Column:
    """R2 with sample weights. ``shift`` is any value near the label mean; it only guards precision."""
    y, p, w = _c(y), _c(p), _c(w)
    d = y - F.lit(float(shift))
    sse = F.sum(w * F.pow(y - p, 2))
    sst = F.sum(w * d * d) - F.pow(F.sum(w * d), 2) / F.sum(w)
    return (
        F.when(F.count(y) < 2, F.lit(float("nan")))
        .when(F.max(y) == F.min(y), F.when(sse == 0, 1.0).otherwise(0.0))
        .otherwise(1.0 - sse / sst)
    )


def score(metric: str, y: Column | str, p: Column | str) -> Column:
    """Higher-is-better score by name; an unknown name is a ``ValueError``."""
    if metric == "r2":
        return r2(y, p)
    if metric == "neg_mean_squared_error":
        return -mse(y, p)
    if metric == "neg_mean_absolute_error":
        return -mae(y, p)
    raise ValueError(f"unsupported metric {metric!r}; choose one of {', '.join(METRICS)}")


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``(n, r2, rmse, mae)``."""
    return df.agg(
        F.count(label).alias("n"),
        r2(label, prediction).alias("r2"),
        rmse(label, prediction).alias("rmse"),
        mae(label, prediction).alias("mae"),
    )


def fold_scores(long: DataFrame, by: Sequence[str] = ("model", "repeat", "fold"),
                label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Scores of out-of-fold predictions in long form, all models and folds in one aggregation."""
    return long.groupBy(*by).agg(
        F.count(label).alias("n"),
        r2(label, prediction).alias("r2"),
        rmse(label, prediction).alias("rmse"),
        mae(label, prediction).alias("mae"),
    )


def cv_summary(scores: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and population standard deviation of the fold scores."""
    aggs = []
    for m in ("r2", "rmse", "mae"):
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return scores.groupBy(*by).agg(*aggs) if by else scores.agg(*aggs)


def compare_predictions(df: DataFrame, predictions: Sequence[str], label: str = "label") -> DataFrame:
    """Scores of several prediction columns of one table, in one pass."""
    pairs = ", ".join(f"'{p}', cast(`{p}` as double)" for p in predictions)
    long = df.select(label, F.expr(f"stack({len(predictions)}, {pairs}) as (model, prediction)"))
    return fold_scores(long, ["model"], label)
