"""Tree families backed by Spark ML, under the parameter names users know."""

from __future__ import annotations

import math

from pyspark.ml import regression as ml
from pyspark.ml.base import Model
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasSeed
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame

from fitmesh.functions.vectors import as_vector, width
from fitmesh.models.base import ColumnNames, Configurable, Regressor, param, score_model
from fitmesh.models.cart import TreesModel, grow_trees
from fitmesh.session import held

DEEPEST = 30  # Spark ML's limit; stands for an unlimited depth
_NATIVE = {c.__name__: c for c in (ml.DecisionTreeRegressionModel, ml.RandomForestRegressionModel, ml.GBTRegressionModel)}


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession,
                                         extraMetadata={"native": type(self.instance.native).__name__})
        self.instance.native.save(f"{path}/native")


class _Reader(MLReader):
    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = NativeTreeModel(_NATIVE[meta["native"]].load(f"{path}/native"))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class NativeTreeModel(Configurable, ColumnNames, Model, MLReadable, MLWritable):
    """A fitted Spark ML tree model that reads array or vector features."""

    def __init__(self, native=None, **values):
        super().__init__(**values)
        self.native = native

    def _transform(self, df: DataFrame) -> DataFrame:
        vec = df.withColumn("_vec", as_vector(df, self.getFeaturesCol()))
        native = self.native
        return native.transform(vec, {native.featuresCol: "_vec", native.predictionCol: self.getPredictionCol()}).drop("_vec")

    def score(self, df: DataFrame, weight: str | None = None) -> float:
        return score_model(self, df, weight)

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader()


class TreeRegressor(Regressor, HasSeed):
    """Shared plumbing; ``weight_column`` is used by boosting."""

    max_bins = param("max_bins", "candidate thresholds per feature", TypeConverters.toInt)

    def __init__(self, **values):
        self._weight: str | None = None
        super().__init__(**values)
        self._setDefault(seed=42, max_bins=32)

    def native(self):
        raise NotImplementedError

    def weighted(self, column: str) -> "TreeRegressor":
        out = self.copy()
        out._weight = column
        return out

    def _fit(self, df: DataFrame) -> NativeTreeModel:
        from pyspark.sql import functions as F

        label = self.getLabelCol()
        cols = [as_vector(df, self.getFeaturesCol()).alias("_vec"), F.col(label).cast("double").alias(label)]
        if self._weight:
            cols.append(F.col(self._weight))
        estimator = self.native().setFeaturesCol("_vec").setLabelCol(label).setSeed(self.getSeed()).setMaxBins(self.get("max_bins"))
        if self._weight:
            estimator = estimator.setWeightCol(self._weight)
        data = held(df.select(*cols))
        try:
            return self._hand_over(NativeTreeModel(estimator.fit(data)))
        finally:
            data.unpersist()


def _depth(value) -> int:
    if value is not None and int(value) > DEEPEST:
        raise ValueError(f"max_depth is at most {DEEPEST}; None grows as deep as that")
    return DEEPEST if value is None else int(value)


def _boosted(rounds: int, rate: float, depth: int, subsample: float = 1.0) -> ml.GBTRegressor:
    """Spark fits each tree to twice the residual, so half the rate gives the usual shrinkage.

    Spark's first tree enters at full weight instead of a constant start.
    """
    return ml.GBTRegressor(maxIter=rounds, stepSize=rate / 2.0, maxDepth=depth, subsamplingRate=subsample, lossType="squared")


class DecisionTree(Regressor, HasSeed):
    """Exact splits, grown until leaves are pure or nodes have fewer than ``min_samples_split`` rows."""

    max_depth = param("max_depth", "None: no limit")
    min_samples_split = param("min_samples_split", "rows a node needs to be split", TypeConverters.toInt)
    DEFAULTS = {"max_depth": None, "min_samples_split": 2, "seed": 42}

    def _fit(self, df: DataFrame) -> TreesModel:
        depth = self.get("max_depth")
        return self._hand_over(grow_trees(df, self.getFeaturesCol(), self.getLabelCol(), 1, None if depth is None else int(depth),
                                          self.get("min_samples_split"), None, False, self.getSeed()))


class BinnedTree(TreeRegressor):
    """Spark's tree on binned thresholds; takes row weights."""

    max_depth = param("max_depth", "None: as deep as Spark allows")
    DEFAULTS = {"max_depth": None}

    def native(self):
        return ml.DecisionTreeRegressor(maxDepth=_depth(self.get("max_depth")))


class RandomForest(TreeRegressor):
    """Spark's forest where it can honour the settings; exact trees for ``min_samples_split`` above 2 or depths above Spark's limit."""

    n_estimators = param("n_estimators", "trees", TypeConverters.toInt)
    max_depth = param("max_depth", "None: no limit")
    min_samples_split = param("min_samples_split", "rows a node needs to be split", TypeConverters.toInt)
    max_features = param("max_features", "sqrt, log2, None (all) or a share")
    bootstrap = param("bootstrap", "resample rows per tree", TypeConverters.toBoolean)
    DEFAULTS = {"n_estimators": 100, "max_depth": None, "min_samples_split": 2, "max_features": None, "bootstrap": True}

    def _fit(self, df: DataFrame):
        depth = self.get("max_depth")
        if depth is not None and int(depth) <= DEEPEST and self.get("min_samples_split") <= 2:
            return super()._fit(df)
        p = width(df, self.getFeaturesCol())
        wanted = self.get("max_features")
        count = {"sqrt": int(math.sqrt(p)), "log2": int(math.log2(p))}.get(str(wanted)) if isinstance(wanted, str) and not wanted.replace(".", "").isdigit() else None
        if wanted is not None and count is None:
            count = int(float(wanted) * p)
        return self._hand_over(grow_trees(
            df, self.getFeaturesCol(), self.getLabelCol(), self.get("n_estimators"), None if depth is None else int(depth), self.get("min_samples_split"),
            None if count is None else max(1, min(p, count)), self.get("bootstrap"), self.getSeed()))

    def native(self):
        wanted = self.get("max_features")
        strategy = "all" if wanted in (None, 1.0) else str(wanted)
        return ml.RandomForestRegressor(numTrees=self.get("n_estimators"), maxDepth=_depth(self.get("max_depth")),
                                        featureSubsetStrategy=strategy, bootstrap=self.get("bootstrap"))


class GradientBoosting(TreeRegressor):
    n_estimators = param("n_estimators", "boosting rounds", TypeConverters.toInt)
    learning_rate = param("learning_rate", "shrinkage", TypeConverters.toFloat)
    max_depth = param("max_depth", "tree depth", TypeConverters.toInt)
    DEFAULTS = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3}

    def native(self):
        return _boosted(self.get("n_estimators"), self.get("learning_rate"), _depth(self.get("max_depth")))
