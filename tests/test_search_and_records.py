import math
import time

import numpy as np
import pytest
from frames import r2 as r2_of
from frames import signal, vectors
from pyspark.sql import functions as F

from fitmesh.functions import metrics as M
from fitmesh.models.linear import OLS, Ridge
from fitmesh.models.trees import DecisionTree, RandomForest
from fitmesh.operators.outliers import KMeansOutlier
from fitmesh.operators.reduce import PCA
from fitmesh.operators.scale import RobustScale, StandardScale
from fitmesh.operators.splits import repeated_kfold
from fitmesh.plans.chain import MODELS, Chain, clean_names
from fitmesh.plans.crossval import cross_validate, cross_validate_keep_best, moment_solver
from fitmesh.plans.ensemble import EnsembleModel, blend, promote_if_better, stack_models
from fitmesh.plans.parallel import run_limited
from fitmesh.plans.run import run
from fitmesh.plans.search import (Candidate, FOREST_GRID, MUTATIONS, PortfolioSearch, RoundSearch, draw_combinations, meta_search,
                                  random_search)
from fitmesh.plans.selection import champion_row, leaderboard
from fitmesh.sources import records

FOLDS = ["fold_r0", "fold_r1"]


def folded(spark, n=240, width=3):
    x, y = signal(n)
    if width > 3:
        x = np.column_stack([x, np.random.default_rng(0).normal(size=(n, width - 3))])
    return repeated_kfold(vectors(spark, x, y), ["id"], 4, 2), x, y


@pytest.mark.parametrize("width", [3, 20])
def test_one_pass_cross_validation_equals_refitting(spark, width):
    df, x, y = folded(spark, width=width)
    got = {(r["repeat"], r["fold"]): r for r in cross_validate(OLS(), df, FOLDS).collect()}
    rows = df.orderBy("id").select(*FOLDS).toPandas()
    assert len(got) == 8
    for (rep, f), r in got.items():
        test = rows[FOLDS[rep]].to_numpy() == f
        a = np.column_stack([x, np.ones(len(x))])
        w = np.linalg.lstsq(a[~test], y[~test], rcond=None)[0]
        p = a[test] @ w
        assert abs(r["r2"] - r2_of(y[test], p)) < 1e-9
        assert abs(r["rmse"] - math.sqrt(((y[test] - p) ** 2).mean())) < 1e-9
        assert abs(r["mae"] - np.abs(y[test] - p).mean()) < 1e-9


@pytest.mark.parametrize("steps", [[StandardScale()], [StandardScale(), PCA(n_components=2)], [PCA(variance=0.8)]])
def test_chained_one_pass_equals_refitting(spark, steps):
    df, *_ = folded(spark)
    chain = Chain(steps, Ridge(alpha=3.0))
    assert moment_solver(chain) is not None
    fast = {(r["repeat"], r["fold"]): r["r2"] for r in cross_validate(chain, df, FOLDS).collect()}
    _, slow = cross_validate_keep_best(chain, df, FOLDS)
    for r in slow.collect():
        assert abs(r["r2"] - fast[(r["repeat"], r["fold"])]) < 1e-9


def test_other_preparations_are_refitted_per_fold(spark):
    df, *_ = folded(spark)
    assert moment_solver(Chain([RobustScale()], OLS())) is None
    assert moment_solver(Chain([KMeansOutlier()], OLS())) is None
    assert moment_solver(DecisionTree()) is None
    assert cross_validate(Chain([RobustScale()], OLS()), df, ["fold_r0"]).count() == 4


def test_keep_best_returns_the_top_fold(spark):
    df, *_ = folded(spark)
    model, scores = cross_validate_keep_best(DecisionTree(max_depth=4), df, ["fold_r0"])
    top = scores.orderBy(F.desc("r2")).first()
    assert abs(model.score(df.filter(F.col("fold_r0") == top["fold"])) - top["r2"]) < 1e-9


def test_metric_rules(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (1.0, 1.0, 2.0)], "y double, exact double, off double")
    assert df.agg(M.r2("y", "exact")).first()[0] == 1.0
    assert df.agg(M.r2("y", "off")).first()[0] == 0.0
    assert math.isnan(df.limit(1).agg(M.r2("y", "exact")).first()[0])
    with pytest.raises(ValueError):
        M.score("accuracy", "y", "exact")
    assert df.agg(M.score("neg_mean_absolute_error", "y", "off")).first()[0] == -1.0


def test_champion_rule(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0, "a", nan), (1, "b", 0.5), (2, "c", 0.5), (3, "d", None)], "ord int, model string, r2_mean double")
    assert champion_row(df)["model"] == "b"
    assert [r["model"] for r in leaderboard(df, "r2_mean").orderBy("rank").collect()] == ["b", "c", "a", "d"]
    with pytest.raises(RuntimeError):
        champion_row(df.filter("r2_mean is null or isnan(r2_mean)"))


def test_draw_is_seeded_and_without_replacement():
    a = draw_combinations(FOREST_GRID, 20)
    assert a == draw_combinations(FOREST_GRID, 20) and a != draw_combinations(FOREST_GRID, 20, seed=1)
    assert len({str(c) for c in draw_combinations(FOREST_GRID, 500)}) == 180


def test_clean_names():
    assert clean_names(["B", "x", "B", "A"], ["A", "B"], ["D"]) == ["B", "A"]
    assert clean_names(["x"], ["A"], ["D"]) == ["D"]


def test_random_search_shares_passes_and_refits(spark):
    x, y = signal(200)
    df = vectors(spark, x, y)
    found = random_search(df, Ridge, {"alpha": [0.1, 1e6]}, 2, key=["id"])
    assert found.best == {"alpha": 0.1} and found.model.score(df) > 0.1
    forest = random_search(df, RandomForest, {"n_estimators": [2, 3], "max_depth": [2, None]}, 2, key=["id"], n_splits=2, n_repeats=1)
    assert forest.table.count() == 2 and forest.model is not None


def test_portfolio_records_failures_and_ignores_unknown_names(spark):
    x, y = signal(200)

    def broken():
        raise RuntimeError("bad stage")

    found = PortfolioSearch(families=["OLS", "Nope", "DecisionTree"], settings={"DecisionTree": {"max_depth": 5}},
                            preparations=[None, "StandardScaler", "Nope"], extra=[Candidate("Broken", maker=broken)]).run(vectors(spark, x, y), ["id"])
    rows = {r["model"]: r for r in found.table.collect()}
    assert len(rows) == 5 and rows["Broken"]["status"] == "failed" and "bad stage" in rows["Broken"]["error"]
    assert "DecisionTree" in found.best["model"]


def test_round_search_stops_without_gain(spark):
    calls = []

    def evaluate(batch, left):
        calls.append(len(batch))
        return [(c, "ok", 0.5, "", 0.0) for c in batch]

    RoundSearch(families=["RandomForest"], population=2, generations=50, patience=3).run(spark.range(1), ["id"], evaluate)
    assert len(calls) == 4  # one gain, then three rounds without


def test_round_search_defaults_let_patience_act(spark):
    calls = []

    def evaluate(batch, left):
        calls.append(len(batch))
        return [(c, "ok", 0.5, "", 0.0) for c in batch]

    search = RoundSearch(families=["RandomForest", "GradientBoosting", "ExtraTrees", "XGBoost", "MLP"])
    assert (search.population, search.generations, search.patience) == (100, 100, 20)
    search.run(spark.range(1), ["id"], evaluate)
    assert calls[0] == 100 and len(calls) <= 21  # one gain, then at most 20 rounds without
    for family, values in MUTATIONS.items():
        defaults = MODELS[family].DEFAULTS
        assert all(defaults[k] in v for k, v in values.items() if k in defaults), family


def _strategies():
    class Broken:
        name = "broken"

        def run(self, df, key):
            raise RuntimeError("no luck")

    return [PortfolioSearch(name="a", families=["Ridge"]), Broken(), PortfolioSearch(name="b", families=["OLS"])]


def test_meta_search_does_not_depend_on_parallelism(spark):
    x, y = signal(200)
    df = vectors(spark, x, y)
    one, many = (meta_search(df, _strategies(), ["id"], 3, 2, parallelism=p) for p in (1, 3))
    cols = ["rank", "model", "status", "r2_mean", "rmse_std"]
    assert one.leaderboard.select(cols).orderBy("rank").collect() == many.leaderboard.select(cols).orderBy("rank").collect()
    assert one.champion == many.champion and set(one.models) == {"a", "b"}
    with pytest.raises(RuntimeError, match="no luck"):
        meta_search(df, [_strategies()[1]], ["id"], 3, 1)


def test_overrunning_task_is_cancelled(spark):
    def slow():
        return spark.range(4, numPartitions=4).mapInArrow(lambda b: (time.sleep(60), b)[1], "id long").count()

    began = time.time()
    out = run_limited(spark, [slow, lambda: 7, lambda: 1 / 0], 3, task_seconds=2.0)
    assert [o.status for o in out] == ["timeout", "ok", "failed"] and out[1].value == 7
    assert time.time() - began < 40
    late = run_limited(spark, [lambda: time.sleep(0.4), lambda: 1], 1, total_seconds=0.2)
    assert late[1].status == "skipped"


def test_blend_stack_and_promotion(spark, tmp_path):
    x, y = signal(300)
    df = repeated_kfold(vectors(spark, x, y), ["id"], 3, 1)
    members = [OLS().fit(df), DecisionTree(max_depth=5).fit(df)]
    mixed = blend(members)
    p = [np.array([r["prediction"] for r in m.transform(df).orderBy("id").collect()]) for m in [*members, mixed]]
    assert np.allclose(p[2], (p[0] + p[1]) / 2)
    mixed.save(str(tmp_path / "m"))
    again = EnsembleModel.load(str(tmp_path / "m"))
    assert np.allclose([r["prediction"] for r in again.transform(df).orderBy("id").collect()], p[2])
    for mode in ("oof", "train"):
        stacked = stack_models([OLS(), DecisionTree(max_depth=5)], df, stack_on=mode)
        assert r2_of(y, np.array([r["prediction"] for r in stacked.transform(df).orderBy("id").collect()])) > r2_of(y, p[0])
    tie = df.select("label", F.lit(0.0).alias("c"), F.lit(0.0).alias("b"))
    assert promote_if_better(tie, "c", "b").first()["promoted"] is False
    assert blend([]) is None


def test_run_writes_a_valid_record_and_reloadable_models(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, "pq"[i % 2], float(a), float(b), float(2 * a - b + (i % 2) * 3)) for i, (a, b) in enumerate(rng.normal(size=(250, 2)))]
    df = spark.createDataFrame(rows, "k long, c string, a double, b double, y double")
    out = run(df, ["k"], [PortfolioSearch(families=["OLS"]), RoundSearch(families=["Ridge"], population=2, generations=1)], label="y",
              n_splits=3, n_repeats=1, root=str(tmp_path), dataset="toy", parallelism=2)
    assert out.holdout["r2"] > 0.6
    recs = records.read_records(spark, str(tmp_path))
    assert [r["valid"] for r in records.validate_run(recs).collect()] == [True]
    catalog = records.run_catalog(recs).collect()
    assert {r["engine"] for r in catalog} == {"portfolio", "rounds"} and catalog[0]["run_dataset"] == "toy"
    again = records.load_champion(out.run_dir + "/overall_champion")
    a, b = ([r["prediction"] for r in m.transform(df).orderBy("k").collect()] for m in (out.model, again))
    assert np.allclose(a, b)
    with pytest.raises(ValueError):
        run(df, ["k"], [], fit_scope="some")


def test_validation_lists_missing_parts(spark):
    frame = records.record_frame(spark, [{"champion_engine": "x"}])
    row = records.validate_run(frame).first()
    assert not row["valid"] and "holdout_metrics" in row["missing"] and "champion_engine" not in row["missing"]


def test_search_results_and_events(spark, tmp_path):
    table = spark.createDataFrame([(42, "n=1;d=None", 0.5)], "seed int, params string, score double")
    records.write_search_results(table, str(tmp_path / "s.csv"))
    back = spark.read.csv(str(tmp_path / "s.csv"), header=True).first()
    assert (back["params"], back["best_r2"]) == ("n=1;d=None", "0.5")
    records.write_best_params(spark, {"alpha": 1.0}, 0.9, str(tmp_path / "b.json"))
    assert spark.read.json(str(tmp_path / "b.json")).first()["best_score"] == 0.9
    events = spark.createDataFrame([records.event("a", "start", n=1), records.event("a", "end")], records.EVENT_DDL)
    records.write_events(events, str(tmp_path / "e"))
    assert records.read_events(spark, str(tmp_path / "e")).count() == 2
    assert any(p.name.startswith("event_date=") for p in (tmp_path / "e").iterdir())


def test_run_ignores_a_column_named_id_and_follows_the_metric(spark):
    rng = np.random.default_rng(2)
    rows = [(i, 7, float(a), float(b), float(2 * a - b)) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))]
    df = spark.createDataFrame(rows, "k long, id long, a double, b double, y double")
    portfolio = PortfolioSearch(families=["OLS"])
    out = run(df, ["k"], [portfolio, PortfolioSearch(name="other", families=["Ridge"])], label="y", columns=["a", "b"], metric="neg_mean_absolute_error", n_splits=2, n_repeats=1)
    assert out.holdout["r2"] > 0.99 and out.record["run_meta"]["metric"] == "neg_mean_absolute_error"
    assert portfolio.metric == "r2"  # the caller's object is left alone


def test_record_holds_its_folds_and_parts(spark, tmp_path, monkeypatch):
    """Every scan of the table hashes the keys again; models and scores read what is held."""
    from fitmesh.queries import outputs

    rows = [(i, 1, i % 7, i % 5, float(i % 50 + 1), 900.0 + 13 * (i * i % 101), (i % 11) / 100, (i % 9) / 100, "A", "F") for i in range(200)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, "
                                "l_tax double, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    held, kept = outputs.held, []
    monkeypatch.setattr(outputs, "held", lambda df: kept.append(held(df)) or kept[-1])
    record = outputs._record(spark, str(tmp_path))
    assert record["dataset"]["n_rows"] == 200
    assert len(kept) == 3 and all("id" not in df.columns or len(df.columns) > 2 for df in kept)
    assert not any(df.storageLevel.useMemory for df in kept)


def test_a_preparation_is_fitted_once_for_all_families(spark, monkeypatch):
    """And when it fails, every candidate that has it fails, the others go on."""
    from fitmesh.operators.scale import RobustScale, StandardScale

    fits, fit = [], StandardScale._fit
    monkeypatch.setattr(StandardScale, "_fit", lambda self, df: fits.append(1) or fit(self, df))

    def broken(self, df):
        raise RuntimeError("no scale")

    monkeypatch.setattr(RobustScale, "_fit", broken)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((80, 2))
    df = spark.createDataFrame([(i, v.tolist(), float(v[0] + 2 * v[1])) for i, v in enumerate(x)], "id long, features array<double>, label double")
    found = PortfolioSearch(families=["Ridge", "OLS"], preparations=[None, "StandardScaler", "RobustScaler"]).run(df, ["id"])
    assert len(fits) == 1
    status = {r["model"]: (r["status"], r["error"]) for r in found.table.collect()}
    assert {m for m, (s, _) in status.items() if s == "ok"} == {"Ridge", "OLS", "StandardScaler+Ridge", "StandardScaler+OLS"}
    assert all("no scale" in status[f"RobustScaler+{f}"][1] for f in ("Ridge", "OLS"))


def test_cross_validation_leaves_a_held_table_held(spark):
    """A search holds its table for all candidates; the first one's cross-validation must not let it go."""
    from pyspark import StorageLevel

    from fitmesh.plans.crossval import cross_validate_keep_best
    from fitmesh.session import held

    rows = [(i % 2, [float(i), float(i % 5)], float(3 * i)) for i in range(40)]
    df = spark.createDataFrame(rows, "fold int, features array<double>, label double")
    data = held(df)
    try:
        cross_validate(DecisionTree(max_depth=2), data, ["fold"])
        assert data.storageLevel != StorageLevel.NONE
        cross_validate_keep_best(DecisionTree(max_depth=2), data, ["fold"])
        assert data.storageLevel != StorageLevel.NONE
    finally:
        data.unpersist()
    cross_validate(DecisionTree(max_depth=2), data, ["fold"])
    assert data.storageLevel == StorageLevel.NONE


def _lines(spark, path):
    rows = [(i, 1, i % 7, i % 5, float(i % 50), 100.0 * i, i % 11 / 100, i % 9 / 100, "A", "F") for i in range(80)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string").write.parquet(str(path / "lineitem.parquet"))
    return str(path)


def test_portfolio_query_runs_families_at_their_defaults(spark, tmp_path, monkeypatch):
    from fitmesh.plans import search
    from fitmesh.queries import QUERIES

    tried = []
    monkeypatch.setattr(search, "evaluate_candidates", lambda cs, *rest: tried.extend(cs) or [(c, "ok", 0.5, "", 0.0) for c in cs])
    assert QUERIES["portfolio_families"](spark, _lines(spark, tmp_path)).count() == len(tried) == 9
    for c in tried:
        regressor, defaults = c.estimator().regressor, MODELS[c.family].DEFAULTS
        assert {k: regressor.get(k) for k in defaults} == defaults, c.name


def test_round_query_runs_until_patience_ends_it(spark, tmp_path, monkeypatch):
    from fitmesh.plans import search
    from fitmesh.queries import QUERIES

    rounds = []
    monkeypatch.setattr(search, "evaluate_candidates", lambda cs, *rest: rounds.append(cs) or [(c, "ok", 0.5, "", 0.0) for c in cs])
    assert QUERIES["round_search"](spark, _lines(spark, tmp_path)).count() == sum(map(len, rounds)) == 2 * (5 + 4 * 3 + 5 * 3)  # every setting with and without a scaler
    assert len(rounds[0]) > 50
