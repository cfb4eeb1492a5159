"""The complete run: features, hold-out, search, champion, blend, hold-out scores, record, saved models."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.hashing import key_text
from fitmesh.functions.metrics import evaluate, score
from fitmesh.operators.splits import holdout_split
from fitmesh.plans.crossval import out_of_fold
from fitmesh.plans.ensemble import blend, predict_all
from fitmesh.plans.features import FeaturePipeline
from fitmesh.plans.search import MetaResult, meta_search
from fitmesh.session import held
from fitmesh.sources import records


ROW = "_row_key"


@dataclass
class RunResult:
    model: PipelineModel
    champion: str
    search: MetaResult
    holdout: dict[str, float]
    record: dict
    run_dir: str | None


def run(df: DataFrame, key: Sequence[str], strategies: Sequence, label: str = "label", columns: Sequence[str] | None = None,
        fit_scope: str = "train", metric: str = "r2", ensemble: bool = True, promote_on: str = "oof", parallelism: int = 1,
        n_splits: int = 5, n_repeats: int = 3, test_size: float = 0.2, seed: int = 42, budget: float | None = None,
        root: str | None = None, dataset: str = "dataset", data_path: str = "", target_path: str = "") -> RunResult:
    """Fit everything on the training rows and report on the untouched hold-out.

    ``fit_scope="all"`` fits the features on all rows and ``promote_on="holdout"``
    promotes the blend by its hold-out score: both leak and exist for parity.
    ``metric`` rules the strategies' searches, the champion and the promotion.
    """
    began = time.monotonic()
    if fit_scope not in ("train", "all") or promote_on not in ("oof", "holdout"):
        raise ValueError("fit_scope is 'train' or 'all'; promote_on is 'oof' or 'holdout'")
    source = df.withColumn(ROW, key_text(key))  # never a column of the caller's
    split = holdout_split(source, key, test_size, seed)
    fit_rows = split if fit_scope == "all" else split.filter("not is_test")
    engineered = FeaturePipeline(columns=columns, keys=[*key, ROW, "is_test"], labelCol=label).fit(fit_rows)
    table = engineered.transform(split)
    keep = [*dict.fromkeys([*key, ROW]), F.col(label).cast("double").alias("label"), "features", "is_test"]
    table = held(table.select(*keep).withMetadata("features", {"width": engineered.n_components}))
    try:
        train, test = table.filter("not is_test").drop("is_test"), table.filter("is_test").drop("is_test")
        search = meta_search(train, strategies, key, n_splits, n_repeats, metric, parallelism, seed, budget)
        champion, model = search.champion, search.models[search.champion]
        if ensemble and len(search.models) > 1:
            mixed = blend(list(search.models.values()))
            if promote_on == "holdout":
                scored = predict_all([model, mixed], test)
            else:  # out-of-fold predictions of every member; the blend is their mean
                scored = _out_of_fold_pair(search, train, key, n_splits, seed)
            row = scored.agg(score(metric, "label", "p0").alias("champion"), score(metric, "label", "p1").alias("blend")).first()
            if row["blend"] is not None and row["blend"] > row["champion"]:
                champion, model = "blend", mixed
        final = evaluate(model.transform(test)).first()
        n_rows = table.count()
    finally:
        table.unpersist()
    holdout = {m: float(final[m]) for m in ("r2", "rmse", "mae")}
    steps = search.estimators[search.champion].description() if champion != "blend" else [
        {"step": "mean_blend", "params": {"members": ",".join(search.models)}}]
    record = {
        "run_meta": {"timestamp_utc": datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
                     "budget_seconds": None if budget is None else int(budget), "metric": metric,
                     "engines_invoked": [s.name for s in strategies], "ensemble_enabled": bool(ensemble and len(strategies) > 1),
                     "total_duration_seconds": time.monotonic() - began, "data_path": data_path, "target_path": target_path},
        "dataset": {"data_path": data_path, "target_path": target_path, "n_rows": n_rows,
                    "n_features": engineered.n_components, "target_name": label},
        "champion_engine": champion, "holdout_metrics": holdout, "per_engine_cv_metrics": search.metrics,
        "champion_pipeline_info": steps,
    }
    full = PipelineModel([engineered, model])
    run_dir = None
    if root:
        run_dir = records.run_path(root, dataset)
        spark = df.sparkSession
        records.write_run_record(spark, record, run_dir)
        records.save_all({"overall": full, **{n: PipelineModel([engineered, m]) for n, m in search.models.items()}}, run_dir)
    return RunResult(full, champion, search, holdout, record, run_dir)


def _out_of_fold_pair(search: MetaResult, train: DataFrame, key: Sequence[str], n_splits: int, seed: int) -> DataFrame:
    """``label, p0, p1``: out-of-fold predictions of the champion and of the mean of all strategies."""
    from fitmesh.operators.splits import repeated_kfold

    folded = repeated_kfold(train, key, n_splits, 1, seed)
    names = list(search.estimators)
    parts = [out_of_fold(search.estimators[n], folded, ["fold_r0"], keep=[ROW]).withColumn("model", F.lit(n)) for n in names]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    # ids are unique, so groups hold one row per strategy
    return long.groupBy(ROW).agg(
        F.first("label").alias("label"),
        F.max(F.when(F.col("model") == search.champion, F.col("prediction"))).alias("p0"),
        F.avg("prediction").alias("p1"))
