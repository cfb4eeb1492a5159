"""Row-level outlier removal. Everything is fitted on the given rows and masks whole rows."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasSeed
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.forest import FlatForest
from fitmesh.functions.vectors import as_array, as_vector, map_rows, matrix, width
from fitmesh.models.base import Configurable, StateModel, param
from fitmesh.operators.knn import BLOCK_ROWS, knn_join
from fitmesh.operators.lookup import keyed_lookup
from fitmesh.operators.lsh import lsh_knn_join
from fitmesh.operators.orderstats import quantiles
from fitmesh.session import durable, held

AUTO = "auto"
_BROADCAST_RATIO = 1e-4  # at most 10,000 kept groups


def drop_small_groups(df: DataFrame, label: str, ratio: float) -> DataFrame:
    """Rows of groups that hold at least ``ratio`` of all rows.

    At most ``1/ratio`` groups can qualify, so the kept set is broadcast unless
    the ratio is tiny.
    """
    if not 0.0 < ratio <= 1.0:
        return df
    total = df.count()
    kept = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= F.lit(float(ratio) * total))
    same = df[label].eqNullSafe(F.col("_keep"))
    keep = kept.select(F.col(label).alias("_keep"))
    return df.join(F.broadcast(keep) if ratio >= _BROADCAST_RATIO else keep, same, "left_semi")


# --------------------------------------------------------------------------- isolation forest

def average_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` leaves."""
    n = np.asarray(n, dtype=float)
    big = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def _mix(h: np.ndarray, tree: int) -> np.ndarray:
    """Independent 64-bit hash per tree from one row hash (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        z = h + np.uint64((0x9E3779B97F4A7C15 * (tree + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _grow(x: np.ndarray, features: np.ndarray, limit: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes ``(id, feature, threshold, left, right, path)``; ``feature = -1`` marks a leaf."""
    nodes, todo, used = [], [(0, np.arange(len(x)), 0)], 1
    while todo:
        node, rows, depth = todo.pop()
        spread = x[rows].max(axis=0) - x[rows].min(axis=0) if len(rows) else np.zeros(x.shape[1])
        usable = features[spread[features] > 0]
        if depth >= limit or len(rows) <= 1 or not len(usable):
            nodes.append((node, -1, 0.0, -1, -1, depth + float(average_path(len(rows)))))
            continue
        f = int(rng.choice(usable))
        lo, hi = x[rows, f].min(), x[rows, f].max()
        cut = rng.uniform(lo, hi)
        left = x[rows, f] <= cut
        if left.all():
            left = x[rows, f] < hi
        nodes.append((node, f, float(cut), used, used + 1, 0.0))
        todo += [(used, rows[left], depth + 1), (used + 1, rows[~left], depth + 1)]
        used += 2
    return sorted(nodes)


class IsolationForestModel(StateModel, HasFeaturesCol):
    """Node arrays of all trees (at most 2*256 nodes each) and the score threshold."""

    contamination = param("contamination", "auto or share of outliers")

    def anomaly(self, df: DataFrame) -> DataFrame:
        """Adds ``score`` in (0, 1]; higher is more anomalous."""
        forest = FlatForest(*[self.state[c] for c in ("tree", "feature", "threshold", "left", "right", "path")])
        norm = float(self.state["norm"])

        def score(x):
            return 2.0 ** (-forest.mean(x) / norm)

        return df.withColumn("score", map_rows(score, as_array(df, self.getFeaturesCol())))

    def _transform(self, df: DataFrame) -> DataFrame:
        scored = self.anomaly(df)
        limit = float(self.state["limit"])
        return scored.withColumn("is_inlier", F.col("score") <= F.lit(limit))


class OutlierEstimator(Configurable, HasFeaturesCol, HasSeed):
    """``mask(df)`` adds ``score`` and ``is_inlier``; ``clean(df)`` drops the outlier rows."""

    idCol = param("idCol", "unique row id", TypeConverters.toString)

    def mask(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def clean(self, df: DataFrame) -> DataFrame:
        masked = self.mask(df)
        return masked.filter("is_inlier").select(*[F.col(f"`{c}`") for c in df.columns])


class IsolationForest(OutlierEstimator):
    n_estimators = param("n_estimators", "trees", TypeConverters.toInt)
    max_samples = param("max_samples", "rows per tree", TypeConverters.toInt)
    contamination = param("contamination", "auto or share of outliers")
    max_features = param("max_features", "share of features per tree", TypeConverters.toFloat)
    DEFAULTS = {"n_estimators": 100, "max_samples": 256, "contamination": AUTO, "max_features": 1.0, "seed": 42, "idCol": "id"}

    def fit(self, df: DataFrame) -> IsolationForestModel:
        trees, psi, seed = self.get("n_estimators"), self.get("max_samples"), self.getSeed()
        n, p = df.count(), width(df, self.getFeaturesCol())
        if n == 0:
            raise ValueError("empty input")
        psi = min(psi, n)
        # each tree wants its psi smallest hashes: rows above this bar cannot be among them
        bar = min(1.0, (psi + 8.0 * math.sqrt(psi) + 8.0) / n)
        bar = np.uint64(min(int(bar * 2.0 ** 64), 2 ** 64 - 1))
        cols = df.select(F.xxhash64(F.lit(seed), F.col(self.get("idCol"))).alias("h"), as_array(df, self.getFeaturesCol()).alias("x"))

        def candidates(batches):
            for b in batches:
                h = b.column("h").to_numpy().view(np.uint64)
                for t in range(trees):
                    mixed = _mix(h, t)
                    rows = np.flatnonzero(mixed <= bar)
                    if len(rows):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(rows), t), pa.int32()),
                            pa.array((mixed[rows] >> np.uint64(1)).astype(np.int64)),
                            b.column("x").take(pa.array(rows))], names=["tree", "h", "x"])

        n_features = max(1, int(self.get("max_features") * p))
        limit = max(1, math.ceil(math.log2(max(psi, 2))))

        def build(table):
            t = table.column("tree")[0].as_py()
            order = np.argsort(table.column("h").to_numpy(), kind="stable")[:psi]
            x = matrix(table.column("x"))[order]
            rng = np.random.default_rng([seed, t])
            features = np.sort(rng.choice(p, n_features, replace=False))
            nodes = _grow(x, features, limit, rng)
            cols = list(zip(*nodes))
            return pa.table({"tree": pa.array([t] * len(nodes), pa.int32()), "node": pa.array(cols[0], pa.int32()),
                             "feature": pa.array(cols[1], pa.int32()), "threshold": pa.array(cols[2], pa.float64()),
                             "left": pa.array(cols[3], pa.int32()), "right": pa.array(cols[4], pa.int32()),
                             "path": pa.array(cols[5], pa.float64())})

        # candidates hold about psi rows per tree whatever the table size, so the groups are bounded
        nodes = cols.mapInArrow(candidates, "tree int, h long, x array<double>").groupBy("tree").applyInArrow(
            build, "tree int, node int, feature int, threshold double, left int, right int, path double")
        table = nodes.toPandas().sort_values(["tree", "node"])  # at most trees * 2 * psi rows
        state = {c: table[c].to_numpy(float) for c in ("tree", "feature", "threshold", "left", "right", "path")}
        model = IsolationForestModel({**state, "norm": max(float(average_path(psi)), 1e-12), "limit": 0.5},
                                     featuresCol=self.getFeaturesCol(), contamination=self.get("contamination"))
        if self.get("contamination") != AUTO:
            share = float(self.get("contamination"))
            scores = held(model.anomaly(df).select("score"))  # the quantile reads them several times
            try:
                model.state["limit"] = np.asarray(quantiles(scores, ["score"], [1.0 - share])["score"][0])
            finally:
                scores.unpersist()
        return model

    def mask(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


# --------------------------------------------------------------------------- local outlier factor

def local_outlier_factor(df: DataFrame, k: int, id_column: str, vector: str, pivots: int | None = None,
                         block_rows: int = BLOCK_ROWS, algorithm: str = "auto") -> DataFrame:
    """``(id, lof)`` from neighbour lists (exactly ``k`` neighbours, the row itself left out): exact ones, or hashed with ``lsh``."""
    if algorithm == "lsh":
        pairs = durable(lsh_knn_join(df, None, k, query_id=id_column, vector=vector))
    else:
        pairs = durable(knn_join(df, None, k, query_id=id_column, vector=vector, pivots=pivots, block_rows=block_rows))
    reach_k = pairs.groupBy(F.col("query_id").alias("neighbor_id")).agg(F.max("distance").alias("k_distance"))
    uses = pairs.groupBy("neighbor_id").agg(F.count(F.lit(1)).alias("_uses"))
    reached = keyed_lookup(pairs, reach_k.join(uses, "neighbor_id"), "neighbor_id", "_uses")
    density = durable(reached.groupBy("query_id").agg(
        (1.0 / (F.avg(F.greatest("k_distance", "distance")) + F.lit(1e-10))).alias("lrd")))
    around = keyed_lookup(pairs.select("query_id", "neighbor_id"),
                          density.withColumnRenamed("query_id", "neighbor_id").join(uses, "neighbor_id"), "neighbor_id", "_uses")
    mean = around.groupBy("query_id").agg(F.avg("lrd").alias("_around"))
    return mean.join(density, "query_id").select(F.col("query_id").alias("id"), (F.col("_around") / F.col("lrd")).alias("lof"))


class LocalOutlierFactor(OutlierEstimator):
    """Training rows only: outlier when LOF > 1.5 (``auto``) or above the contamination percentile."""

    n_neighbors = param("n_neighbors", "neighbours", TypeConverters.toInt)
    contamination = param("contamination", "auto or share of outliers")
    algorithm = param("algorithm", "auto (exact) or lsh (hashed neighbours)", TypeConverters.toString)
    DEFAULTS = {"n_neighbors": 20, "contamination": AUTO, "algorithm": "auto", "idCol": "id", "seed": 42}

    def mask(self, df: DataFrame) -> DataFrame:
        k = self.get("n_neighbors")
        n = df.limit(k + 1).count()
        k = max(1, min(k, n - 1))
        lof = durable(local_outlier_factor(df, k, self.get("idCol"), self.getFeaturesCol(), algorithm=self.get("algorithm")))
        limit = 1.5
        if self.get("contamination") != AUTO:
            limit = float(quantiles(lof, ["lof"], [1.0 - float(self.get("contamination"))])["lof"][0])
        return (df.join(lof.select(F.col("id").alias(self.get("idCol")), F.col("lof").alias("score")), self.get("idCol"))
                .withColumn("is_inlier", F.col("score") <= F.lit(limit)))


# --------------------------------------------------------------------------- tiny clusters

class KMeansOutlierModel:
    """Keeps the clustering and the clusters that were too small among the training rows."""

    def __init__(self, clusters, small: list[int], features: str):
        self.clusters, self.small, self.features = clusters, small, features

    def transform(self, df: DataFrame) -> DataFrame:
        vec = df.withColumn("_vec", as_vector(df, self.features))
        out = self.clusters.transform(vec).drop("_vec")
        return out.withColumn("is_inlier", ~F.col("cluster").isin(self.small) if self.small else F.lit(True))


class KMeansOutlier(OutlierEstimator):
    """Drops rows of clusters with fewer than ``min_cluster_size_ratio * n`` rows; best of ``n_init`` runs."""

    n_clusters = param("n_clusters", "clusters", TypeConverters.toInt)
    min_cluster_size_ratio = param("min_cluster_size_ratio", "smallest share kept", TypeConverters.toFloat)
    n_init = param("n_init", "restarts", TypeConverters.toInt)
    DEFAULTS = {"n_clusters": 2, "min_cluster_size_ratio": 0.05, "n_init": 10, "seed": 42, "idCol": "id"}

    def fit(self, df: DataFrame) -> KMeansOutlierModel:
        from fitmesh.plans.parallel import run_all

        vec = held(df.select(as_vector(df, self.getFeaturesCol()).alias("_vec")))
        try:
            fits = run_all([
                lambda s=s: KMeans(k=self.get("n_clusters"), seed=self.getSeed() + s, featuresCol="_vec",
                                   predictionCol="cluster").fit(vec)
                for s in range(self.get("n_init"))], 4)
            best = min(fits, key=lambda m: m.summary.trainingCost)
            counts = {r["cluster"]: r["count"] for r in best.transform(vec).groupBy("cluster").count().collect()}
        finally:
            vec.unpersist()
        n = sum(counts.values())
        small = [c for c, m in counts.items() if m < self.get("min_cluster_size_ratio") * n]
        return KMeansOutlierModel(best, sorted(small), self.getFeaturesCol())

    def mask(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)
