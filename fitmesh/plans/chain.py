"""Preparation steps and a regressor as one estimator; the fitted form is a plain ``PipelineModel``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame

from fitmesh.models.adaboost import AdaBoost
from fitmesh.models.base import Configurable
from fitmesh.models.extratrees import ExtraTrees
from fitmesh.models.linear import OLS, ElasticNet, Lasso, Ridge
from fitmesh.models.mlp import MLP
from fitmesh.models.neighbours import KNN
from fitmesh.models.svr import SVR
from fitmesh.models.boosting import LightGBM, XGBoost
from fitmesh.models.trees import DecisionTree, GradientBoosting, RandomForest
from fitmesh.operators.outliers import IsolationForest, KMeansOutlier, LocalOutlierFactor, OutlierEstimator
from fitmesh.operators.reduce import PCA
from fitmesh.operators.scale import QuantileTransform, RobustScale, StandardScale

# the canonical order also breaks ties between equal scores
MODELS = {
    "Ridge": Ridge, "Lasso": Lasso, "ElasticNet": ElasticNet, "SVR": SVR, "DecisionTree": DecisionTree,
    "RandomForest": RandomForest, "ExtraTrees": ExtraTrees, "GradientBoosting": GradientBoosting, "AdaBoost": AdaBoost,
    "MLP": MLP, "XGBoost": XGBoost, "LightGBM": LightGBM, "KNN": KNN, "OLS": OLS,
}
PREPARATIONS = {
    "PCA": PCA, "RobustScaler": RobustScale, "StandardScaler": StandardScale, "QuantileTransform": QuantileTransform,
    "KMeansOutlier": KMeansOutlier, "IsolationForest": IsolationForest, "LocalOutlierFactor": LocalOutlierFactor,
}
LIGHT_DEFAULT = ["Ridge", "DecisionTree"]


class Chain(Configurable, HasLabelCol, HasPredictionCol, Estimator):
    """Scalers and reducers become stages of the fitted model; outlier steps only remove training rows."""

    def __init__(self, steps: Sequence, regressor, name: str | None = None, **values):
        super().__init__(**values)
        self.steps, self.regressor = list(steps), regressor
        family = getattr(regressor, "family", type(regressor).__name__)
        self.name = name or "+".join([*[type(s).__name__ for s in self.steps], family])
        self._set(labelCol=regressor.getOrDefault("labelCol"), predictionCol=regressor.getOrDefault("predictionCol"))

    def description(self) -> list[dict]:
        """``{step, params}`` of every step, for run records."""
        out = []
        for s in [*self.steps, self.regressor]:
            settings = s.settings() if hasattr(s, "settings") else {p.name: str(v) for p, v in s.extractParamMap().items()}
            out.append({"step": getattr(s, "family", type(s).__name__), "params": settings})
        return out

    def prepared(self, df: DataFrame) -> tuple[list, DataFrame]:
        """The fitted steps, and the rows that the regressor is fitted to."""
        stages = []
        for step in self.steps:
            if isinstance(step, OutlierEstimator):
                df = step.clean(df)
            else:
                model = step.fit(df)
                df = model.transform(df)
                stages.append(model)
        return stages, df

    def _fit(self, df: DataFrame) -> PipelineModel:
        stages, df = self.prepared(df)
        return PipelineModel([*stages, self.regressor.fit(df)])


def clean_names(wanted: Sequence[str] | None, allowed: Sequence[str], default: Sequence[str]) -> list[str]:
    """Known names once each, in the given order; an empty outcome gives ``default``."""
    names = [w for w in dict.fromkeys(wanted or []) if w in set(allowed)]
    return names or list(default)


def make(name: str, **settings):
    """A model or preparation step by name."""
    table = MODELS if name in MODELS else PREPARATIONS
    if name not in table:
        raise ValueError(f"unknown component {name!r}")
    return table[name](**settings)
