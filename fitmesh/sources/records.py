"""Run records, catalogues, saved models, search results and event logs."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitmesh.session import ensure_checkpoint_dir

REQUIRED = ("run_meta", "dataset", "champion_engine", "holdout_metrics", "per_engine_cv_metrics", "champion_pipeline_info")

_RUN_DDL = (
    "run_meta struct<timestamp_utc: string, budget_seconds: int, metric: string, engines_invoked: array<string>, "
    "ensemble_enabled: boolean, total_duration_seconds: double, data_path: string, target_path: string>, "
    "dataset struct<data_path: string, target_path: string, n_rows: bigint, n_features: int, target_name: string>, "
    "champion_engine string, "
    "holdout_metrics struct<r2: double, rmse: double, mae: double>, "
    "per_engine_cv_metrics map<string, struct<r2_mean: double, r2_std: double, rmse_mean: double, rmse_std: double, "
    "mae_mean: double, mae_std: double, duration_seconds: double>>, "
    "champion_pipeline_info array<struct<step: string, params: map<string, string>>>"
)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def run_path(root: str, dataset: str, when: datetime | None = None) -> str:
    stamp = (when or datetime.now(timezone.utc)).strftime("%Y%m%d-%H%M%S")
    return f"{root.rstrip('/')}/{dataset}/{stamp}"


def record_frame(spark: SparkSession, records: Sequence[dict]) -> DataFrame:
    """Nested run records as a typed DataFrame; absent parts stay null."""
    return spark.createDataFrame(list(records), T.StructType.fromDDL(_RUN_DDL))


def write_run_record(spark: SparkSession, record: dict, run_dir: str) -> str:
    """Append one JSON record to ``<run_dir>/metrics.json`` (a Spark JSON folder)."""
    path = f"{run_dir}/metrics.json"
    record_frame(spark, [record]).coalesce(1).write.mode("append").json(path)
    return path


def read_records(spark: SparkSession, root: str) -> DataFrame:
    """All records below ``root`` with dataset and timestamp taken from their path."""
    path = F.col("_metadata.file_path")
    return (
        spark.read.schema(_RUN_DDL).option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.json").json(root)
        .filter(path.contains("/metrics.json/"))
        .withColumn("run_dataset", F.regexp_extract(path, r"([^/]+)/([^/]+)/metrics\.json/", 1))
        .withColumn("run_timestamp", F.regexp_extract(path, r"([^/]+)/([^/]+)/metrics\.json/", 2))
    )


def run_catalog(records: DataFrame) -> DataFrame:
    """One row per run and engine: dataset, timestamp, champion flag, cross-validation and hold-out scores."""
    return records.select(
        "run_dataset", "run_timestamp", "champion_engine", F.col("holdout_metrics.r2").alias("holdout_r2"),
        F.explode_outer("per_engine_cv_metrics").alias("engine", "m"),
    ).select("run_dataset", "run_timestamp", "engine", (F.col("engine") == F.col("champion_engine")).alias("is_champion"),
             "holdout_r2", "m.*")


def validate_run(records: DataFrame, required: Sequence[str] = REQUIRED) -> DataFrame:
    """``missing`` (sorted names) and ``valid`` per record."""
    absent = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) if c in records.columns else F.lit(c) for c in required]))
    return records.withColumn("missing", F.array_sort(absent)).withColumn("valid", F.size("missing") == 0)


def save_champion(model, run_dir: str, name: str = "overall_champion") -> str:
    path = f"{run_dir}/{name}"
    (model if isinstance(model, PipelineModel) else PipelineModel([model])).save(path)
    return path


def save_all(models: dict, run_dir: str) -> dict[str, str]:
    """One folder per engine champion; many small files, so the writes go side by side."""
    from fitmesh.plans.parallel import run_all

    paths = run_all([lambda n=n, m=m: save_champion(m, run_dir, f"{n}_champion") for n, m in models.items()], 4)
    return dict(zip(models, paths))


def load_champion(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_search_results(table: DataFrame, path: str) -> None:
    """``seed, params, best_r2`` as CSV with a header; settings are one quoted string."""
    table.select("seed", "params", F.col("score").alias("best_r2")).write.mode("append").csv(path, header=True)


def write_best_params(spark: SparkSession, best: dict, score: float, path: str) -> None:
    rows = [({k: str(v) for k, v in best.items()}, float(score))]
    spark.createDataFrame(rows, "best_params map<string,string>, best_score double").coalesce(1).write.mode("overwrite").json(path)


def event(engine: str, name: str, level: str = "INFO", **payload) -> tuple:
    return (datetime.now(timezone.utc), level, engine, name, {k: str(v) for k, v in payload.items()})


EVENT_DDL = "ts timestamp, level string, engine string, event string, payload map<string,string>"


def write_events(events: DataFrame, path: str) -> None:
    """JSON lines in one folder per day. Rows are first gathered by day so that a day has few files.

    Each day is spread over a bounded number of tasks: a busy day is not one task.
    """
    dated = events.withColumn("event_date", F.to_date("ts"))
    dated.repartition(F.col("event_date"), F.pmod(F.xxhash64("ts"), F.lit(8))).write.mode("append").partitionBy("event_date").json(path)


def read_events(spark: SparkSession, path: str, ddl: str = EVENT_DDL) -> DataFrame:
    return spark.read.schema(ddl + ", event_date date").json(path)
