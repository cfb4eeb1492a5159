"""Estimator and model bases on ``pyspark.ml``: Params, persistence, one prediction column."""

from __future__ import annotations

import numpy as np
from pyspark.ml.base import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame


def param(name: str, doc: str, converter=TypeConverters.identity) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=converter)


class Configurable(Params):
    """Keyword construction: class-level ``DEFAULTS`` first, then the caller's values."""

    DEFAULTS: dict = {}

    def __init__(self, **values):
        super().__init__()
        self._setDefault(**self.DEFAULTS)
        self._set(**values)

    def get(self, name: str):
        return self.getOrDefault(name)

    def settings(self) -> dict[str, str]:
        """Hyper-parameters as strings, for leaderboards and run records."""
        skip = {"featuresCol", "labelCol", "predictionCol"}
        return {p.name: str(self.getOrDefault(p)) for p in self.params if p.name not in skip and self.isDefined(p)}


class ColumnNames(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    pass


class Regressor(Configurable, ColumnNames, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """``fit(df)`` reads an array or vector ``featuresCol`` and a numeric ``labelCol``."""

    def __init__(self, **values):
        super().__init__(**values)

    @property
    def family(self) -> str:
        return type(self).__name__

    def _hand_over(self, model):
        """Give the fitted model this estimator's column names."""
        return self._copyValues(model)


class StateWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.instance, path, spark)
        rows = [(k, [int(s) for s in np.shape(v)], [float(x) for x in np.ravel(v)]) for k, v in self.instance.state.items()]
        spark.createDataFrame(rows, "name string, shape array<long>, items array<double>").coalesce(1).write.parquet(f"{path}/state")


class StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = self.cls()
        instance._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(instance, meta)
        instance.state = {
            r["name"]: np.array(r["items"], dtype=float).reshape(r["shape"])
            for r in self.sparkSession.read.parquet(f"{path}/state").collect()
        }
        return instance


class StateModel(Configurable, Model, MLReadable, MLWritable):
    """A fitted stage whose whole state is a few driver-sized arrays."""

    def __init__(self, state: dict[str, np.ndarray] | None = None, **values):
        super().__init__(**values)
        self.state = {k: np.asarray(v, dtype=float) for k, v in (state or {}).items()}

    def write(self) -> StateWriter:
        return StateWriter(self)

    @classmethod
    def read(cls) -> StateReader:
        return StateReader(cls)

    def __getattr__(self, name):
        state = self.__dict__.get("state", {})
        if name in state:
            value = state[name]
            return float(value) if value.ndim == 0 else value
        raise AttributeError(name)


class RegressionModel(StateModel, ColumnNames):
    def score(self, df: DataFrame, weight: str | None = None) -> float:
        """R2 on ``df``, optionally weighted."""
        return score_model(self, df, weight)


def score_model(model, df: DataFrame, weight: str | None = None) -> float:
    from pyspark.sql import functions as F

    from fitmesh.functions.metrics import r2, weighted_r2

    label, pred = model.getOrDefault("labelCol"), model.getOrDefault("predictionCol")
    scored = model.transform(df)
    if weight is None:
        return scored.agg(r2(label, pred).alias("r2")).first()["r2"]
    shift = df.select(F.col(label).cast("double").alias("v")).limit(256).agg(F.avg("v")).first()[0] or 0.0
    return scored.agg(weighted_r2(label, pred, weight, shift).alias("r2")).first()["r2"]
