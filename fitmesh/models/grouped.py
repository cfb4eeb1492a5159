"""One least-squares model per group, solved from grouped sums: rows of a group never meet in one task."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.models.linear import LinearRegressor, OLS
from fitmesh.operators.lookup import keyed_lookup
from fitmesh.operators.stats import sufficient_stats, unpack


def fit_by_group(df: DataFrame, keys: Sequence[str], x: Sequence[str], y: str, estimator: LinearRegressor | None = None) -> DataFrame:
    """``keys, n, coefficients, intercept, r2`` (training R2), one row per group."""
    estimator = estimator or OLS()
    centre = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate([*x, y])]).limit(256).toPandas()
    shift = centre.mean().fillna(0.0).to_numpy() if len(centre) else np.zeros(len(x) + 1)
    stats = sufficient_stats(df, list(x), y, keys, shift)

    def solve(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                m = unpack(r.n, r.sum_x, r.sum_y, r.xtx, r.xty, r.yty, shift)
                w, b = estimator.solve(m)
                s = m.scatter
                p = len(w)
                sse = s[p, p] - 2 * w @ s[:p, p] + w @ s[:p, :p] @ w
                rows.append((list(map(float, w)), float(b), 1.0 - sse / s[p, p] if s[p, p] > 0 else float("nan")))
            fit = pd.DataFrame(rows, columns=["coefficients", "intercept", "r2"])
            yield pd.concat([pdf[[*keys, "n"]].reset_index(drop=True), fit], axis=1)

    types = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return stats.mapInPandas(solve, f"{types}, n long, coefficients array<double>, intercept double, r2 double")


def predict_by_group(df: DataFrame, fits: DataFrame, keys: Sequence[str], x: Sequence[str], out: str = "prediction") -> DataFrame:
    """Each row scored by its own group's model; rows of unknown groups get null."""
    pack = F.struct(*[F.col(k) for k in keys])
    table = fits.select(pack.alias("_group"), "coefficients", "intercept", "n")
    joined = keyed_lookup(df.withColumn("_group", pack), table, "_group", "n")
    value = F.col("intercept")
    for i, c in enumerate(x):
        value = value + F.col("coefficients")[i] * F.col(f"`{c}`")
    return joined.withColumn(out, value).drop("_group", "coefficients", "intercept")
