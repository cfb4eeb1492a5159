"""k-nearest-neighbour regression on the exact or the hashed neighbour join."""

from __future__ import annotations

from pyspark.ml.base import Model
from pyspark.ml.param import TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.vectors import as_array
from fitmesh.models.base import ColumnNames, Configurable, Regressor, param, score_model
from fitmesh.operators.knn import knn_join
from fitmesh.operators.lookup import keyed_lookup
from fitmesh.operators.lsh import lsh_knn_join


class _KNNParams(Configurable):
    n_neighbors = param("n_neighbors", "neighbours per query", TypeConverters.toInt)
    weights = param("weights", "uniform or distance", TypeConverters.toString)
    algorithm = param("algorithm", "auto and the tree names use pivots, brute does not, all exact; lsh hashes (approximate, for many dimensions)", TypeConverters.toString)
    idCol = param("idCol", "unique row id (bigint or string)", TypeConverters.toString)
    DEFAULTS = {"n_neighbors": 5, "weights": "uniform", "algorithm": "auto", "idCol": "id"}


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.rows.write.parquet(f"{path}/rows")


class _Reader(MLReader):
    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = KNNModel(self.sparkSession.read.parquet(f"{path}/rows"))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class KNNModel(_KNNParams, ColumnNames, Model, MLReadable, MLWritable):
    """Keeps the training rows as a table; prediction is a neighbour join."""

    def __init__(self, rows: DataFrame | None = None, **values):
        super().__init__(**values)
        self.rows = rows

    def _transform(self, df: DataFrame) -> DataFrame:
        id_column, out = self.get("idCol"), self.getPredictionCol()
        columns = {"query_id": id_column, "base_id": "id", "vector": self.getFeaturesCol(), "base_vector": "features"}
        if self.get("algorithm") == "lsh":
            pairs = lsh_knn_join(df, self.rows, self.get("n_neighbors"), **columns)
        else:
            pairs = knn_join(df, self.rows, self.get("n_neighbors"), pivots=1 if self.get("algorithm") == "brute" else None, **columns)
        scored = combine_labels(pairs, self.rows.select(F.col("id").alias("neighbor_id"), "label"), self.get("weights"))
        return df.join(scored.withColumnRenamed("query_id", id_column).withColumnRenamed("prediction", out), id_column, "left")

    def score(self, df: DataFrame, weight: str | None = None) -> float:
        return score_model(self, df, weight)

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader()


def combine_labels(pairs: DataFrame, labels: DataFrame, weights: str) -> DataFrame:
    """Mean label of the neighbours; ``distance`` weights by 1/d, an exact match takes the label alone.

    One training row may be a neighbour of very many queries, so labels are
    looked up by the skew-safe join.
    """
    popular = labels.join(pairs.groupBy("neighbor_id").agg(F.count(F.lit(1)).alias("_uses")), "neighbor_id")
    named = keyed_lookup(pairs, popular, "neighbor_id", "_uses")
    if weights == "uniform":
        value = F.avg("label")
    elif weights == "distance":
        exact = F.avg(F.when(F.col("distance") == 0, F.col("label")))
        inverse = F.when(F.col("distance") > 0, 1.0 / F.col("distance"))
        value = F.coalesce(exact, F.sum(inverse * F.col("label")) / F.sum(inverse))
    else:
        raise ValueError("weights must be 'uniform' or 'distance'")
    return named.groupBy("query_id").agg(value.alias("prediction"))


class KNN(_KNNParams, Regressor):
    def _fit(self, df: DataFrame) -> KNNModel:
        if self.get("algorithm") not in ("auto", "brute", "kd_tree", "ball_tree", "lsh"):
            raise ValueError("unknown algorithm")
        rows = df.select(F.col(self.get("idCol")).alias("id"), as_array(df, self.getFeaturesCol()).alias("features"),
                         F.col(self.getLabelCol()).cast("double").alias("label"))
        return self._hand_over(KNNModel(rows))
