"""Run records, saved models, catalogues, result files, event logs, user stages and the complete run."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from fitmesh.functions import metrics as M
from fitmesh.functions.vectors import assemble
from fitmesh.models.linear import OLS, Ridge
from fitmesh.models.user import UserRegressor, UserTransformer
from fitmesh.operators.scale import StandardScale
from fitmesh.operators.splits import repeated_kfold
from fitmesh.plans.crossval import cross_validate, cross_validate_summary
from fitmesh.plans.run import run
from fitmesh.plans.search import PortfolioSearch, RoundSearch, random_search
from fitmesh.queries.data import exact_folds_sql
from fitmesh.queries.models import FOLDS, HOLDOUT, SCORES, SUMMARY_SQL, SUMMARY, fold_scores_sql, oof_sql, scores_sql, split_rows
from fitmesh.queries.registry import LI, hash_sql, lines, metrics_sql, query, rounded, table, with_features
from fitmesh.session import held
from fitmesh.sources import records


def _record(spark, sf_dir):
    """A record from two cross-validated models and one hold-out score."""
    li = with_features(lines(spark, sf_dir), ["price"], "id")
    folded = held(repeated_kfold(li, ["id"], 5, 3).drop("id"))  # each row's hashes are computed once
    engines = {"least_squares": OLS(), "ridge": Ridge(alpha=1e13)}
    cv = {n: {**cross_validate_summary(e, folded, FOLDS).drop("model").first().asDict(), "duration_seconds": 0.0} for n, e in engines.items()}
    folded.unpersist()
    train, test = (held(part) for part in split_rows(spark, sf_dir, ["price"]))
    hold = M.evaluate(OLS().fit(train).transform(test)).first()
    n_rows = train.count() + test.count()
    for part in (train, test):
        part.unpersist()
    return {
        "run_meta": {"timestamp_utc": "2025-01-01T00:00:00Z", "budget_seconds": 60, "metric": "r2", "engines_invoked": list(engines),
                     "ensemble_enabled": False, "total_duration_seconds": 1.0, "data_path": sf_dir, "target_path": sf_dir},
        "dataset": {"data_path": sf_dir, "target_path": sf_dir, "n_rows": n_rows, "n_features": 1, "target_name": "label"},
        "champion_engine": "least_squares",
        "holdout_metrics": {m: hold[m] for m in ("r2", "rmse", "mae")},
        "per_engine_cv_metrics": cv,
        "champion_pipeline_info": [{"step": "OLS", "params": OLS().settings()}],
    }


_CV = f"""{LI}, {exact_folds_sql(5, 3)}, {oof_sql('price', 'a')}, {oof_sql('price', 'b', '1e13')},
s AS (SELECT 'least_squares' AS engine, * FROM ({fold_scores_sql('a')}) UNION ALL SELECT 'ridge', * FROM ({fold_scores_sql('b')}))"""


@query("run_record", f"""
WITH {HOLDOUT}, p AS (SELECT label, price * wp + bp AS prediction FROM te, w), s AS (SELECT {metrics_sql('label', 'prediction')} FROM p)
SELECT 'least_squares' AS champion_engine, 'r2' AS metric, (SELECT count(*) FROM li) AS n_rows, 2 AS n_engines, 'OLS' AS first_step, {scores_sql()} FROM s""")
def run_record(spark, sf_dir):
    root = records.scratch_path(spark, "runs")
    path = records.write_run_record(spark, _record(spark, sf_dir), records.run_path(root, "lineitem"))
    r = records.read_records(spark, path.rsplit("/", 1)[0])
    out = r.select("champion_engine", "run_meta.metric", "dataset.n_rows", F.size("per_engine_cv_metrics").alias("n_engines"),
                   F.col("champion_pipeline_info")[0]["step"].alias("first_step"), "holdout_metrics.*")
    return rounded(out, SCORES)


@query("run_catalog", f"""
WITH {_CV} SELECT 'lineitem' AS run_dataset, engine, engine = 'least_squares' AS is_champion, {SUMMARY_SQL} FROM s GROUP BY engine""")
def run_catalog_query(spark, sf_dir):
    root = records.scratch_path(spark, "runs")
    records.write_run_record(spark, _record(spark, sf_dir), records.run_path(root, "lineitem"))
    catalog = records.run_catalog(records.read_records(spark, root))
    return rounded(catalog.select("run_dataset", "engine", "is_champion", *SUMMARY), SUMMARY)


@query("validate_run", f"""
WITH {LI} SELECT 'complete' AS which, '' AS missing, true AS valid, count(*) AS n_rows FROM li
UNION ALL SELECT 'partial', 'champion_engine,holdout_metrics', false, count(*) FROM li""")
def validate_run_query(spark, sf_dir):
    whole = _record(spark, sf_dir)
    part = {**{k: v for k, v in whole.items() if k not in ("champion_engine", "holdout_metrics")}}
    root = records.scratch_path(spark, "runs")
    records.write_run_record(spark, whole, f"{root}/complete/1")
    records.write_run_record(spark, part, f"{root}/partial/1")
    checked = records.validate_run(records.read_records(spark, root))
    return checked.select(F.col("run_dataset").alias("which"), F.array_join("missing", ",").alias("missing"), "valid", "dataset.n_rows")


@query("saved_model", f"""
WITH {LI}, w AS (SELECT regr_slope(label, price) AS w, regr_intercept(label, price) AS b FROM li)
SELECT id, round(price * w + b, 2) AS prediction FROM li, w""")
def saved_model(spark, sf_dir):
    """Scaler and regression saved, reloaded and applied."""
    li = with_features(lines(spark, sf_dir), ["price"], "id")
    scaler = StandardScale().fit(li)
    model = PipelineModel([scaler, OLS().fit(scaler.transform(li))])
    path = records.save_champion(model, records.scratch_path(spark, "run"))
    return records.load_champion(path).transform(li).select("id", F.round("prediction", 2).alias("prediction"))


@query("search_results_csv", f"""
WITH {LI}, {exact_folds_sql(5, 2)}, {oof_sql('price', 'a0', '0.0')}, {oof_sql('price', 'a1', '1e13')},
s AS (SELECT 'alpha=0.0' AS params, * FROM ({fold_scores_sql('a0')}) UNION ALL SELECT 'alpha=10000000000000.0', * FROM ({fold_scores_sql('a1')}))
SELECT 42 AS seed, params, round(avg(r2), 8) AS best_r2 FROM s GROUP BY params""")
def search_results_csv(spark, sf_dir):
    found = random_search(with_features(lines(spark, sf_dir), ["price"], "id"), Ridge, {"alpha": [0.0, 1e13]}, 2, key=["id"], refit=False)
    path = records.scratch_path(spark, "search") + ".csv"
    records.write_search_results(found.table, path)
    return rounded(spark.read.schema("seed int, params string, best_r2 double").csv(path, header=True), {"best_r2": 8})


@query("event_log", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, event_type AS event, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2""")
def event_log(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "ts", F.lit("INFO").alias("level"), F.lit("events").alias("engine"), F.col("event_type").alias("event"),
        F.create_map(F.lit("user_id"), F.col("user_id").cast("string")).alias("payload"))
    path = records.scratch_path(spark, "events")
    records.write_events(e, path)
    return records.read_events(spark, path).groupBy(F.col("event_date").cast("string").alias("event_date"), "event").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.col("payload")["user_id"]).alias("users"))


# a user's own stages: three NumPy functions each


def mean_partial(x, y):
    return {"n": len(y), "s": y.sum()}


def mean_finish(sums):
    return {"mean": sums["s"] / sums["n"]}


def mean_predict(params, x):
    return np.full(len(x), float(params["mean"][0]))


def max_partial(x, y):
    return {"n": len(x), "s": np.abs(x).sum(axis=0)}


def max_finish(sums):
    return {"scale": sums["s"] / sums["n"]}


def max_apply(params, x):
    return x / params["scale"]


@query("user_model", f"""
WITH {LI}, {exact_folds_sql(5, 1)}, t AS (SELECT fold, count(*) AS n, sum(label) AS s FROM li JOIN folds USING (id) GROUP BY fold),
f AS (SELECT fold, (sum(s) OVER () - s) / (sum(n) OVER () - n) AS prediction FROM t),
m AS (SELECT fold, count(*) AS n, {metrics_sql('label', 'prediction')} FROM li JOIN folds USING (id) JOIN f USING (fold) GROUP BY fold)
SELECT 'user_mean' AS model, 0 AS repeat, fold, n, {scores_sql()} FROM m""")
def user_model(spark, sf_dir):
    """A user-defined mean model goes through the same cross-validation as any family."""
    stage = UserRegressor(mean_partial, mean_finish, mean_predict, name="user_mean")
    folded = repeated_kfold(with_features(lines(spark, sf_dir), ["price"], "id"), ["id"], 5, 1)
    return rounded(cross_validate(stage, folded, ["fold_r0"], "user_mean"), SCORES)


@query("user_transformer", f"""
WITH {LI}, m AS (SELECT avg(abs(qty)) AS a, avg(abs(price)) AS b FROM li) SELECT id, round(qty / a, 5) AS qty, round(price / b, 5) AS price FROM li, m""")
def user_transformer(spark, sf_dir):
    v = assemble(lines(spark, sf_dir), ["qty", "price"])
    out = UserTransformer(max_partial, max_finish, max_apply).fit_transform(v)
    return out.select("id", F.round(F.col("features")[0], 5).alias("qty"), F.round(F.col("features")[1], 5).alias("price"))


_TRAIN = f"""{LI}, r0 AS (SELECT *, row_number() OVER (ORDER BY {hash_sql(42)}) - 1 AS rk, count(*) OVER () AS m FROM li),
te AS (SELECT * FROM r0 WHERE rk < ceil(0.2 * m)), tr AS (SELECT * FROM r0 WHERE NOT rk < ceil(0.2 * m))"""


@query("single_feature_run", f"""
WITH {_TRAIN}, {exact_folds_sql(5, 3, 'tr')}, {oof_sql('price', 'a', source='tr')}, s AS ({fold_scores_sql('a')}),
w AS (SELECT regr_slope(label, price) AS w, regr_intercept(label, price) AS b FROM tr),
p AS (SELECT label, price * w + b AS prediction FROM te, w), h AS (SELECT 1 - sum(pow(label - prediction, 2)) / (count(*) * var_pop(label)) AS r2 FROM p)
SELECT 'least_squares' AS engine, true AS is_champion, (SELECT round(r2, 8) FROM h) AS holdout_r2, {SUMMARY_SQL} FROM s""")
def single_feature_run(spark, sf_dir):
    """The complete run where scaling and one component leave least squares unchanged."""
    root = records.scratch_path(spark, "runs")
    run(lines(spark, sf_dir).select("id", "price", "label"), ["id"], [PortfolioSearch(name="least_squares", families=["OLS"])],
        root=root, dataset="lineitem")
    catalog = records.run_catalog(records.read_records(spark, root))
    return rounded(catalog.select("engine", "is_champion", "holdout_r2", *SUMMARY), {"holdout_r2": 8, **SUMMARY})


@query("complete_run")
def complete_run(spark, sf_dir):
    """Features, hold-out, two strategies, champion, blend, record and saved models; the catalogue row is returned."""
    li = lines(spark, sf_dir, "l_returnflag", "l_linestatus")
    root = records.scratch_path(spark, "runs")
    result = run(li, ["id"], [PortfolioSearch(families=["Ridge", "OLS"]), RoundSearch(families=["ElasticNet"], population=2, generations=2)],
                 columns=["l_returnflag", "l_linestatus", "qty", "price", "disc", "tax"], root=root, dataset="lineitem", parallelism=2)
    return records.run_catalog(records.read_records(spark, root)).drop("run_timestamp", "duration_seconds").withColumn(
        "champion", F.lit(result.champion))
