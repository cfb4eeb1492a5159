"""Mean target encoding of string columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.base import Estimator, Model
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasLabelCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.models.base import Configurable, param
from fitmesh.operators.lookup import keyed_lookup
from fitmesh.session import durable


def category_means(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """``(column_no, category, mean, rows)`` of all columns from one pass with map-side combine.

    Column number -1 holds the one row of overall figures.
    """
    entries = F.explode(F.array(F.struct(F.lit(-1).alias("column_no"), F.lit("").alias("category")), *[
        F.struct(F.lit(i).alias("column_no"), F.col(f"`{c}`").cast("string").alias("category")) for i, c in enumerate(columns)]))
    long = df.select(entries.alias("e"), F.nanvl(F.col(label).cast("double"), F.lit(None)).alias("y"))
    return (long.select("e.*", "y").filter(F.col("category").isNotNull())
            .groupBy("column_no", "category").agg(F.avg("y").alias("mean"), F.count(F.lit(1)).alias("rows")))


class _Reader(MLReader):
    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        table = self.sparkSession.read.parquet(f"{path}/means")
        model = TargetEncodeModel(table, meta["global_mean"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession,
                                         extraMetadata={"global_mean": self.instance.global_mean})
        self.instance.means.write.parquet(f"{path}/means")


class TargetEncodeModel(Configurable, Model, MLReadable, MLWritable):
    """Replaces each category by its mean; null, unseen and mean-less categories get the global mean.

    The category table is a DataFrame (it may be as long as a key column) and is
    only broadcast when it is small.
    """

    columns = param("columns", "encoded columns", TypeConverters.toListString)

    def __init__(self, means: DataFrame | None = None, global_mean: float | None = None, **values):
        super().__init__(**values)
        self.means, self.global_mean = means, global_mean
        self._sizes: dict[int, tuple[int, int]] | None = None

    def sizes(self) -> dict[int, tuple[int, int]]:
        if self._sizes is None:
            rows = self.means.groupBy("column_no").agg(
                F.sum(32 + F.coalesce(F.octet_length("category"), F.lit(0))).alias("bytes"), F.sum("rows").alias("total")).collect()
            self._sizes = {r["column_no"]: (r["bytes"], r["total"]) for r in rows}
        return self._sizes

    def _transform(self, df: DataFrame) -> DataFrame:
        order = df.columns
        for i, c in enumerate(self.get("columns")):
            size, total = self.sizes().get(i, (0, 0))
            table = self.means.filter(F.col("column_no") == i).select(
                F.col("category").alias(c), F.col("mean").alias("_mean"), F.col("rows").alias("_rows"))
            df = keyed_lookup(df, table, c, "_rows", size, total)
            df = df.withColumn(c, F.coalesce("_mean", F.lit(self.global_mean))).drop("_mean")
        return df.select(*[F.col(f"`{c}`") for c in order])

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader()


class TargetEncode(Configurable, HasLabelCol, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    columns = param("columns", "string columns to encode", TypeConverters.toListString)

    def _fit(self, df: DataFrame) -> TargetEncodeModel:
        label, columns = self.getLabelCol(), self.get("columns")
        # written once: the fitted table must not change or be recomputed under later jobs
        means = durable(category_means(df, columns, label))
        overall = means.filter("column_no = -1").first()
        return TargetEncodeModel(means, overall["mean"] if overall else None, columns=columns)
