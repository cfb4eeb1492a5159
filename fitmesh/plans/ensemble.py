"""Blends and stacks of fitted models."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.base import Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.metrics import compare_predictions, r2
from fitmesh.functions.vectors import assemble
from fitmesh.models.base import ColumnNames, Configurable
from fitmesh.models.linear import OLS


def mean_blend(predictions: Sequence[str]) -> Column:
    """Unweighted mean of prediction columns."""
    return reduce(lambda a, b: a + b, [F.col(p) for p in predictions]) / F.lit(float(len(predictions)))


def promote_if_better(df: DataFrame, champion: str, blend: str, label: str = "label") -> DataFrame:
    """``r2_champion, r2_blend, promoted``: the blend wins only when strictly better."""
    return df.agg(r2(label, champion).alias("r2_champion"), r2(label, blend).alias("r2_blend")).withColumn(
        "promoted", F.col("r2_blend") > F.col("r2_champion"))


def linear_stack(df: DataFrame, predictions: Sequence[str], label: str = "label"):
    """OLS meta-model over prediction columns; pass out-of-fold predictions unless parity is wanted."""
    return OLS(featuresCol="_meta", labelCol=label).fit(assemble(df, predictions, "_meta"))


def predict_all(models: Sequence, df: DataFrame, prediction: str = "prediction", prefix: str = "p") -> DataFrame:
    """Every model's prediction beside the untouched input columns."""
    kept = list(df.columns)
    names = []
    for i, m in enumerate(models):
        names.append(f"{prefix}{i}")
        # every model reads the original columns, not another model's prepared ones
        originals = {c: F.col(f"`_in_{c}`") for c in kept}
        df = df.withColumns({f"_in_{c}": F.col(f"`{c}`") for c in kept})
        df = m.transform(df).withColumnRenamed(prediction, names[-1])
        df = df.select(*[originals[c].alias(c) for c in kept], *names)
    return df


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        e = self.instance
        DefaultParamsWriter.saveMetadata(e, path, self.sparkSession, extraMetadata={
            "members": len(e.members), "weights": None if e.weights is None else [float(w) for w in e.weights],
            "intercept": float(e.intercept)})
        for i, m in enumerate(e.members):
            (m if isinstance(m, PipelineModel) else PipelineModel([m])).save(f"{path}/member{i}")


class _Reader(MLReader):
    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = EnsembleModel([PipelineModel.load(f"{path}/member{i}") for i in range(meta["members"])],
                              meta["weights"], meta["intercept"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class EnsembleModel(Configurable, ColumnNames, Model, MLReadable, MLWritable):
    """Mean of the members' predictions, or a fixed linear combination when ``weights`` are given."""

    def __init__(self, members: Sequence | None = None, weights: Sequence[float] | None = None, intercept: float = 0.0, **values):
        super().__init__(**values)
        self.members, self.intercept = list(members or []), intercept
        self.weights = None if weights is None else np.asarray(weights, float)

    def _transform(self, df: DataFrame) -> DataFrame:
        kept = df.columns
        out = predict_all(self.members, df, self.getPredictionCol(), "_member")
        names = [f"_member{i}" for i in range(len(self.members))]
        value = mean_blend(names) if self.weights is None else reduce(
            lambda a, b: a + b, [F.col(n) * F.lit(float(w)) for n, w in zip(names, self.weights)], F.lit(float(self.intercept)))
        return out.select(*[F.col(f"`{c}`") for c in kept], value.alias(self.getPredictionCol()))

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader()


def blend(members: Sequence) -> EnsembleModel | None:
    return EnsembleModel(members) if members else None


def stack_models(estimators: Sequence, train: DataFrame, fold_column: str = "fold_r0", stack_on: str = "oof",
                 key: str = "id", parallelism: int = 4) -> EnsembleModel:
    """Linear stack of estimators. ``oof`` fits the meta-model on out-of-fold predictions, ``train`` on in-sample ones."""
    from fitmesh.plans.crossval import out_of_fold
    from fitmesh.plans.parallel import run_all

    members = run_all([lambda e=e: e.fit(train) for e in estimators], parallelism)
    if stack_on == "train":
        table = predict_all(members, train)
    elif stack_on == "oof":
        table = None
        for i, e in enumerate(estimators):
            part = out_of_fold(e, train, [fold_column], keep=[key], parallelism=parallelism)
            part = part.select(key, *(["label"] if i == 0 else []), F.col("prediction").alias(f"p{i}"))
            table = part if table is None else table.join(part, key)
    else:
        raise ValueError("stack_on must be 'oof' or 'train'")
    meta = linear_stack(table, [f"p{i}" for i in range(len(members))])
    return EnsembleModel(members, np.atleast_1d(meta.state["coefficients"]), float(meta.state["intercept"]))


def compare_engines(models: dict, df: DataFrame, label: str = "label") -> DataFrame:
    """Hold-out scores of each named model side by side, in one aggregation."""
    names = list(models)
    wide = predict_all([models[n] for n in names], df)
    for i, n in enumerate(names):
        wide = wide.withColumnRenamed(f"p{i}", n)
    return compare_predictions(wide, names, label)
