"""The feature pipeline: encode, interact, scale, reduce; fitted once, usable on new rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.base import Estimator, Model
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasLabelCol
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.vectors import assemble
from fitmesh.models.base import Configurable, param
from fitmesh.operators.columns import interaction_names, select_by_type
from fitmesh.operators.encode import TargetEncode, TargetEncodeModel
from fitmesh.operators.reduce import PCA, PCAModel
from fitmesh.operators.scale import LinearMapModel, StandardScale
from fitmesh.operators.stats import MAX_WIDTH, moments


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        m = self.instance
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"encoded": m.encoder is not None})
        if m.encoder is not None:
            m.encoder.save(f"{path}/encoder")
        m.scaler.save(f"{path}/scaler")
        m.pca.save(f"{path}/pca")


class _Reader(MLReader):
    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = FeaturePipelineModel(
            TargetEncodeModel.load(f"{path}/encoder") if meta["encoded"] else None,
            LinearMapModel.load(f"{path}/scaler"), PCAModel.load(f"{path}/pca"))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class FeaturePipelineModel(Configurable, Model, MLReadable, MLWritable):
    """Adds a ``features`` vector of principal components; every input column is kept."""

    numeric = param("numeric", "model inputs in order, after encoding", TypeConverters.toListString)
    outputCol = param("outputCol", "vector of components", TypeConverters.toString)
    DEFAULTS = {"outputCol": "features"}

    def __init__(self, encoder: TargetEncodeModel | None = None, scaler: LinearMapModel | None = None,
                 pca: PCAModel | None = None, **values):
        super().__init__(**values)
        self.encoder, self.scaler, self.pca = encoder, scaler, pca

    def engineered(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        """Encoded columns and interaction products, as ``_f*`` copies beside the untouched input."""
        numeric = self.get("numeric")
        return engineer(df, self.encoder, numeric)

    def _transform(self, df: DataFrame) -> DataFrame:
        out = self.get("outputCol")
        wide, names = self.engineered(df)
        vec = assemble(wide, names, out).drop(*names)
        for stage in (self.scaler, self.pca):
            vec = _run(stage, vec, out)
        return vec

    @property
    def n_components(self) -> int:
        return len(np.atleast_2d(self.pca.state["components"]))

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader()


def _run(stage, df: DataFrame, column: str) -> DataFrame:
    return stage.transform(df, {stage.inputCol: column, stage.outputCol: column})


def engineer(df: DataFrame, encoder: TargetEncodeModel | None, numeric: Sequence[str], k: int = 3) -> tuple[DataFrame, list[str]]:
    """Copies of the inputs (categories encoded) plus products of the first ``k``; returns the copy names."""
    copies = {f"_f_{c}": F.col(f"`{c}`") for c in numeric}
    wide = df.withColumns(copies)
    if encoder is not None:
        named = encoder.copy({encoder.columns: [f"_f_{c}" for c in encoder.get("columns")]})
        wide = named.transform(wide)
    wide = wide.withColumns({n: F.col(f"`{n}`").cast("double") for n in copies})
    made = interaction_names(list(copies), k)
    if made:
        wide = wide.withColumns({name: F.col(f"`{a}`") * F.col(f"`{b}`") for name, a, b in made})
    return wide, [*copies, *[name for name, _, _ in made]]


class FeaturePipeline(Configurable, HasLabelCol, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Two passes: category means, then one cross-product matrix that yields both scaling and components.

    Without a label the string columns are passed through instead of encoded.
    Rows with null or NaN inputs are an error, as for any fitted scaler.
    """

    columns = param("columns", "input columns; default: every numeric and string column but the label and the keys")
    keys = param("keys", "columns that are never inputs")
    variance = param("variance", "share of variance the components must exceed", TypeConverters.toFloat)
    use_label = param("use_label", "encode strings by label means", TypeConverters.toBoolean)
    outputCol = param("outputCol", "vector of components", TypeConverters.toString)
    DEFAULTS = {"columns": None, "keys": [], "variance": 0.95, "use_label": True, "outputCol": "features"}

    def _fit(self, df: DataFrame) -> FeaturePipelineModel:
        label, out = self.getLabelCol(), self.get("outputCol")
        names = self.get("columns") or [c for c in df.columns if c not in {label, out, *self.get("keys")}]
        strings = [c for c in names if c in select_by_type(df, "categorical")]
        numbers = set(select_by_type(df, "numeric"))
        encoder = None
        if strings and self.get("use_label"):
            encoder = TargetEncode(columns=strings, labelCol=label).fit(df)
            numbers |= set(strings)
        numeric = [c for c in names if c in numbers]
        wide, made = engineer(df, encoder, numeric)
        vec = assemble(wide, made, out).select(out)
        if len(made) <= MAX_WIDTH // 4:
            # scaling and components both follow from one set of sums
            m, p = moments(vec, out), len(made)
            scaler_step, pca_step = StandardScale(), PCA(variance=self.get("variance"))
            unit, _ = scaler_step.from_moments(m.n, m.mean[:p], m.scatter[:p, :p])
            scaler = LinearMapModel({"centre": m.mean[:p], "scale": 1.0 / np.diag(unit)})
            axes, ratio = pca_step.solve(m.n, unit @ m.scatter[:p, :p] @ unit)
            pca = PCAModel({"components": axes, "mean": np.zeros(p), "ratio": ratio[:len(axes)]})
        else:
            scaler = StandardScale(inputCol=out, outputCol=out).fit(vec)
            pca = PCA(inputCol=out, outputCol=out, variance=self.get("variance")).fit(scaler.transform(vec))
        return FeaturePipelineModel(encoder, scaler, pca, numeric=numeric, outputCol=out)
