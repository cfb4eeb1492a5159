"""AdaBoost.R2 (linear loss) over depth-3 trees of rows drawn by weight."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.base import Model
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasSeed
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.vectors import as_vector, matrix
from fitmesh.models.base import ColumnNames, Configurable, Regressor, param, score_model
from fitmesh.models.trees import BinnedTree, NativeTreeModel
from fitmesh.session import durable, spread

_CUT_LINEAGE_EVERY = 5


def loss_summary(df: DataFrame, label: str, prediction: str, weight: str) -> tuple[float, float]:
    """``(largest absolute error, weighted mean of error / largest)`` over rows with weight."""
    err = F.abs(F.col(label) - F.col(prediction))
    r = df.filter(F.col(weight) > 0).agg(F.max(err).alias("top"), (F.sum(F.col(weight) * err) / F.sum(weight)).alias("mean")).first()
    top = float(r["top"] or 0.0)
    return top, (float(r["mean"]) / top if top > 0 else 0.0)


def reweighted(label: str, prediction: str, weight: str, top: float, loss: float, learning_rate: float):
    """The next weight: ``w * beta ** ((1 - error / largest) * learning_rate)``."""
    beta = loss / (1.0 - loss)
    err = F.abs(F.col(label) - F.col(prediction)) / F.lit(top)
    return F.col(weight) * F.pow(F.lit(beta), (1.0 - err) * F.lit(learning_rate))


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession,
                                         extraMetadata={"votes": list(self.instance.votes)})
        for i, tree in enumerate(self.instance.trees):
            tree.save(f"{path}/tree{i}")


class _Reader(MLReader):
    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        votes = meta["votes"]
        model = AdaBoostModel([NativeTreeModel.load(f"{path}/tree{i}") for i in range(len(votes))], votes)
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class AdaBoostModel(Configurable, ColumnNames, Model, MLReadable, MLWritable):
    """Weighted median of the trees' predictions."""

    def __init__(self, trees: list[NativeTreeModel] | None = None, votes=None, **values):
        super().__init__(**values)
        self.trees, self.votes = trees or [], list(votes or [])

    def _transform(self, df: DataFrame) -> DataFrame:
        votes = np.array(self.votes)

        @F.arrow_udf("double")
        def weighted_median(preds: pa.Array) -> pa.Array:
            if not len(preds):
                return pa.array([], pa.float64())
            p = matrix(preds)
            order = np.argsort(p, axis=1, kind="stable")
            cdf = np.cumsum(votes[order], axis=1)
            at = (cdf >= 0.5 * cdf[:, -1:]).argmax(axis=1)
            rows = np.arange(len(p))
            return pa.array(p[rows, order[rows, at]])

        out = df.withColumn("_vec", as_vector(df, self.getFeaturesCol()))
        names = []
        for i, tree in enumerate(self.trees):
            names.append(f"_t{i}")
            native = tree.native
            out = native.transform(out, {native.featuresCol: "_vec", native.predictionCol: names[-1]})
        return out.withColumn(self.getPredictionCol(), weighted_median(F.array(*names))).drop("_vec", *names)

    def score(self, df: DataFrame, weight: str | None = None) -> float:
        return score_model(self, df, weight)

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader()


def drawn(weight: str, partition: str, totals: dict[int, float], draws: dict[int, int], seed: list[int]):
    """How often each row is drawn: ``draws[p]`` draws with replacement from partition ``p``, by ``weight``.

    Batches split the draws of their partition by their share of its weight, so the counts add up exactly. They depend on the
    rows' order in their partition: the table must be a checkpoint.
    """

    @F.arrow_udf("int")
    def counts(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        rng, left, weight_left = None, 0, 0.0
        held_back = next((b for b in parts if len(b[0])), None)
        while held_back is not None:
            w, at = held_back[0].to_numpy(zero_copy_only=False), held_back[1][0].as_py()
            held_back = next((b for b in parts if len(b[0])), None)
            if rng is None:
                rng, left, weight_left = np.random.default_rng([*seed, at]), draws.get(at, 0), totals.get(at, 0.0)
            here = w.sum()
            share = 1.0 if held_back is None else min(1.0, here / weight_left) if weight_left > 0 else 0.0
            k = int(rng.binomial(left, share))
            left, weight_left = left - k, max(0.0, weight_left - here)
            yield pa.array(rng.multinomial(k, w / here if here > 0 else np.full(len(w), 1.0 / len(w))), pa.int32())

    return counts.asNondeterministic()(F.col(weight), F.col(partition))


def draw_rows(df: DataFrame, weight: str, partition: str, totals: dict[int, float], n: int, seed: list[int]) -> DataFrame:
    """The rows of ``n`` draws with replacement by ``weight``, each once with its ``_drawn`` count.

    The driver deals the draws to partitions by their summed weights (one number a partition), tasks deal theirs to rows.
    """
    order = sorted(totals)
    shares = np.array([totals[p] for p in order])
    draws = dict(zip(order, np.random.default_rng(seed).multinomial(n, shares / shares.sum()).tolist()))
    return df.withColumn("_drawn", drawn(weight, partition, totals, draws, seed)).filter("_drawn > 0")


class AdaBoost(Regressor, HasSeed):
    """Each tree is fitted to as many rows as the table has, drawn with replacement by weight.

    ``resample=False`` fits to all rows with their weights. A round costs two jobs beside the tree's: the loss, and the
    next weights, which are kept and summed by partition for the next draw.
    """

    n_estimators = param("n_estimators", "boosting rounds", TypeConverters.toInt)
    learning_rate = param("learning_rate", "shrinkage of the weights", TypeConverters.toFloat)
    max_depth = param("max_depth", "depth of the trees", TypeConverters.toInt)
    resample = param("resample", "draw rows by weight instead of weighting them", TypeConverters.toBoolean)
    DEFAULTS = {"n_estimators": 50, "learning_rate": 1.0, "max_depth": 3, "seed": 42, "resample": True}

    def _fit(self, df: DataFrame) -> AdaBoostModel:
        rate, drawing = self.get("learning_rate"), self.get("resample")
        label = "label"
        data = df.select(as_vector(df, self.getFeaturesCol()).alias("features"), F.col(self.getLabelCol()).cast("double").alias(label))
        # written once: draws follow the order of the rows
        data = durable(spread(data)).withColumns({"_w": F.lit(1.0), "_p": F.spark_partition_id()}).persist(StorageLevel.MEMORY_AND_DISK)
        kept = [data]
        trees, votes = [], []
        try:
            totals = {r["_p"]: r["t"] for r in data.groupBy("_p").agg(F.sum("_w").alias("t")).collect()}
            n = round(sum(totals.values()))
            for i in range(self.get("n_estimators")):
                tree = BinnedTree(max_depth=self.get("max_depth"), seed=self.getSeed() + i)
                if drawing:
                    sample = draw_rows(data, "_w", "_p", totals, n, [self.getSeed(), i]).persist(StorageLevel.MEMORY_AND_DISK)
                    try:
                        tree = tree.weighted("_drawn").fit(sample)
                    finally:
                        sample.unpersist()
                else:
                    tree = tree.weighted("_w").fit(data)
                scored = tree.transform(data)
                top, loss = loss_summary(scored, label, "prediction", "_w")
                if loss <= 0.0:
                    trees.append(tree)
                    votes.append(1.0)
                    break
                if loss >= 0.5:
                    if not trees:
                        trees.append(tree)
                        votes.append(1.0)
                    break
                trees.append(tree)
                votes.append(rate * math.log((1.0 - loss) / loss))
                if i + 1 == self.get("n_estimators"):
                    break
                # weights stay around 1 whatever the number of rounds: the mean of the last ones divides the next
                mean = sum(totals.values()) / n
                data = scored.withColumn("_w", reweighted(label, "prediction", "_w", top, loss, rate) / F.lit(mean)).drop("prediction")
                data = durable(data) if (i + 1) % _CUT_LINEAGE_EVERY == 0 else data.persist(StorageLevel.MEMORY_AND_DISK)
                kept.append(data)
                totals = {r["_p"]: r["t"] for r in data.groupBy("_p").agg(F.sum("_w").alias("t")).collect()}
                if len(kept) > 2:
                    kept.pop(0).unpersist()
        finally:
            for frame in kept:
                frame.unpersist()
        return self._hand_over(AdaBoostModel(trees, votes))
