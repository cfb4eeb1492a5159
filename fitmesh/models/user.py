"""User-defined stages that take part in search like built-in ones.

A user gives NumPy functions; Spark runs them per batch. ``partial(x, y)``
returns named arrays that are summed over all batches, ``finish(sums)`` turns
the sums into parameters, ``predict(params, x)`` or ``transform(params, x)``
applies them. Functions must be importable to be saved.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

import numpy as np
from pyspark.ml.param import TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.vectors import as_array, map_rows, matrix
from fitmesh.models.base import RegressionModel, Regressor, param
from fitmesh.operators.partials import reduce_arrays
from fitmesh.operators.scale import Transformer_, VectorModel


def _sums(df: DataFrame, features: str, label: str | None, partial: Callable) -> dict[str, np.ndarray]:
    """The user's arrays summed over all rows, each as a flat vector."""
    cols = [as_array(df, features).alias("x"), (F.col(label).cast("double") if label else F.lit(0.0)).alias("y")]

    def fold(batches):
        acc: dict[str, np.ndarray] = {}
        for b in batches:
            x = matrix(b.column("x"))
            if not len(x):
                continue
            for name, v in partial(x, b.column("y").to_numpy(zero_copy_only=False)).items():
                v = np.atleast_1d(np.asarray(v, dtype=float)).ravel()
                acc[name] = v if name not in acc else acc[name] + v
        return acc

    return reduce_arrays(df.select(*cols), fold)


def _path(fn: Callable) -> str:
    return f"{fn.__module__}:{fn.__qualname__}"


def _load(path: str) -> Callable:
    module, name = path.split(":")
    out = import_module(module)
    for part in name.split("."):
        out = getattr(out, part)
    return out


class _Applies:
    function = param("function", "importable path of the applying function", TypeConverters.toString)

    def _fn(self) -> Callable:
        fn = self.__dict__.get("_apply")
        return fn if fn is not None else _load(self.get("function"))


class UserModel(_Applies, RegressionModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        fn, params = self._fn(), dict(self.state)
        return df.withColumn(self.getPredictionCol(),
                             map_rows(lambda x: np.asarray(fn(params, x), float), as_array(df, self.getFeaturesCol())))


class UserRegressor(Regressor):
    """``UserRegressor(partial, finish, predict)``: a regression stage from three NumPy functions."""

    def __init__(self, partial: Callable | None = None, finish: Callable | None = None, predict: Callable | None = None,
                 name: str = "UserRegressor", **values):
        super().__init__(**values)
        self.partial, self.finish, self.predict, self.name = partial, finish, predict, name

    @property
    def family(self) -> str:
        return self.name

    def _fit(self, df: DataFrame) -> UserModel:
        params = self.finish(_sums(df, self.getFeaturesCol(), self.getLabelCol(), self.partial))
        model = UserModel(params, function=_path(self.predict))
        model.__dict__["_apply"] = self.predict
        return self._hand_over(model)


class UserTransformModel(_Applies, VectorModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        fn, params = self._fn(), dict(self.state)
        return df.withColumn(self.getOutputCol(),
                             map_rows(lambda x: np.asarray(fn(params, x), float), as_array(df, self.getInputCol()), "array<double>"))


class UserTransformer(Transformer_):
    """A vector-to-vector stage from three NumPy functions; ``fit_transform`` does both steps."""

    def __init__(self, partial: Callable | None = None, finish: Callable | None = None, transform: Callable | None = None, **values):
        super().__init__(**values)
        self.partial, self.finish, self.apply = partial, finish, transform

    def _fit(self, df: DataFrame) -> UserTransformModel:
        params = self.finish(_sums(df, self.getInputCol(), None, self.partial))
        model = UserTransformModel(params, function=_path(self.apply))
        model.__dict__["_apply"] = self.apply
        return self._hand_over(model)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)
