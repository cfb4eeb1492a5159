"""Model search: random search, portfolio search, round search, and the search over strategies."""

from __future__ import annotations

import hashlib
import itertools
import time
from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import Future
from dataclasses import dataclass, field, fields, is_dataclass, replace
from functools import reduce
from threading import Lock

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.metrics import cv_summary, fold_scores
from fitmesh.functions.metrics import score as score_by
from fitmesh.functions.vectors import as_array
from fitmesh.models.linear import LinearRegressor
from fitmesh.models.trees import RandomForest
from fitmesh.operators.splits import holdout_split, repeated_kfold
from fitmesh.operators.stats import fold_moments
from fitmesh.plans.chain import LIGHT_DEFAULT, MODELS, PREPARATIONS, Chain, clean_names, make
from fitmesh.plans.crossval import cross_validate, features_of, fold_prediction, linear_fold_fits
from fitmesh.plans.parallel import run_limited
from fitmesh.plans.selection import champion_row, leaderboard
from fitmesh.session import held

# fixed values: the search grid of the forest tuner
FOREST_GRID = {
    "n_estimators": [50, 100, 150, 200, 300],
    "max_depth": [None, 5, 10, 20],
    "min_samples_split": [2, 5, 10],
    "max_features": ["sqrt", "log2", None],
}

# values a round search may try, per family; the families' defaults are among them
MUTATIONS = {
    "Ridge": {"alpha": [0.01, 0.1, 1.0, 10.0, 100.0]},
    "Lasso": {"alpha": [0.001, 0.01, 0.1, 1.0]},
    "ElasticNet": {"alpha": [0.001, 0.01, 0.1, 1.0], "l1_ratio": [0.15, 0.5, 0.85]},
    "SVR": {"C": [1.0, 10.0, 100.0], "kernel": ["rbf", "linear"]},
    "DecisionTree": {"max_depth": [None, 4, 6, 8, 10], "min_samples_split": [2, 5, 10]},
    "RandomForest": FOREST_GRID,
    "ExtraTrees": {"n_estimators": [20, 50, 100, 200], "max_depth": [None, 5, 8, 20]},
    "GradientBoosting": {"n_estimators": [20, 50, 100, 200], "learning_rate": [0.05, 0.1, 0.3], "max_depth": [3, 5]},
    "AdaBoost": {"n_estimators": [5, 10, 50, 100], "learning_rate": [0.5, 1.0]},
    "MLP": {"hidden_layer_sizes": [[16], [32], [16, 16], [100]], "activation": ["relu", "tanh"], "solver": ["adam", "lbfgs"]},
    "XGBoost": {"n_estimators": [20, 50, 100, 200], "learning_rate": [0.1, 0.3], "max_depth": [4, 6]},
    "LightGBM": {"n_estimators": [20, 50, 100, 200], "num_leaves": [15, 31]},
    "KNN": {"n_neighbors": [3, 5, 10], "weights": ["uniform", "distance"]},
    "OLS": {},
}


def draw_combinations(grid: dict[str, list], n_iter: int, seed: int = 42) -> list[dict]:
    """``n_iter`` distinct settings of the grid, ordered by a hash of seed and position."""
    names = list(grid)
    combos = [dict(zip(names, values)) for values in itertools.product(*grid.values())]
    order = sorted(range(len(combos)), key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())
    return [combos[i] for i in order[:n_iter]]


def params_text(settings: dict) -> str:
    return ";".join(f"{k}={v}" for k, v in settings.items())


def linear_grid_scores(estimators: Sequence[LinearRegressor], names: Sequence[str], df: DataFrame,
                       fold_columns: Sequence[str]) -> DataFrame:
    """Fold scores of many least-squares candidates from two scans in total: one of sums, one of predictions."""
    first = estimators[0]
    label = first.getOrDefault("labelCol")
    folds = fold_moments(df, features_of(first), label, fold_columns)
    x, entries = as_array(df, features_of(first)), []
    for name, e in zip(names, estimators):
        for r, fits in enumerate(linear_fold_fits(e, df, fold_columns, folds)):
            entries.append(F.struct(F.lit(name).alias("model"), F.lit(r).alias("repeat"), F.col(fold_columns[r]).alias("fold"),
                                    fold_prediction(x, F.col(fold_columns[r]), fits).alias("prediction")))
    long = df.select(F.col(label).alias("label"), F.explode(F.array(*entries)).alias("e")).select("label", "e.*")
    return fold_scores(long)


@dataclass
class SearchResult:
    """``table`` is a small DataFrame (one row per candidate); ``estimator``/``model`` are the best ones."""

    table: DataFrame
    best: dict
    score: float
    estimator: object
    model: object = None


def random_search(df: DataFrame, estimator: type = RandomForest, grid: dict[str, list] | None = None, n_iter: int = 20,
                  key: Sequence[str] | None = None, fold_columns: Sequence[str] | None = None, n_splits: int = 5,
                  n_repeats: int = 2, seed: int = 42, parallelism: int = 4, refit: bool = True, fixed: dict | None = None) -> SearchResult:
    """Seeded draw from a grid, mean R2 over all folds, best settings, refit on all rows."""
    grid = grid or FOREST_GRID
    settings = draw_combinations(grid, n_iter, seed)
    if fold_columns is None:
        df = repeated_kfold(df, key, n_splits, n_repeats, seed)
        fold_columns = [f"fold_r{r}" for r in range(n_repeats)]
    df = held(df)
    names = [params_text(s) for s in settings]
    candidates = [estimator(**{**(fixed or {}), **s}) for s in settings]
    try:
        if issubclass(estimator, LinearRegressor):
            scores = cv_summary(linear_grid_scores(candidates, names, df, fold_columns)).select("model", "r2_mean", "r2_std").collect()
            found = {r["model"]: (r["r2_mean"], r["r2_std"]) for r in scores}
        else:
            found = {}
            for name, c in zip(names, candidates):
                r = cv_summary(cross_validate(c, df, fold_columns, name, parallelism)).first()
                found[name] = (r["r2_mean"], r["r2_std"])
        rows = [(i, seed, n, *map(float, found[n])) for i, n in enumerate(names)]
        table = leaderboard(df.sparkSession.createDataFrame(rows, "ord int, seed int, params string, score double, score_std double"))
        best = champion_row(table, "score")
        chosen = candidates[best["ord"]]
        model = chosen.fit(df) if refit else None
    finally:
        df.unpersist()
    return SearchResult(table, settings[best["ord"]], best["score"], chosen, model)


@dataclass
class Candidate:
    family: str
    preparation: str | None = None
    settings: dict = field(default_factory=dict)
    maker: Callable | None = None   # a user's own estimator

    def estimator(self) -> Chain:
        steps = [make(self.preparation)] if self.preparation else []
        return Chain(steps, self.maker() if self.maker else make(self.family, **self.settings), self.name)

    @property
    def name(self) -> str:
        head = f"{self.preparation}+{self.family}" if self.preparation else self.family
        return f"{head}({params_text(self.settings)})" if self.settings else head


def evaluate_candidates(candidates: Sequence[Candidate], train: DataFrame, valid: DataFrame, metric: str = "r2",
                        parallelism: int = 4, budget: float | None = None) -> list[tuple[Candidate, str, float | None, str, float]]:
    """``(candidate, status, score, error, seconds)``; fits run side by side, scores come from one aggregation.

    A preparation that several candidates have is fitted once; with a budget each candidate fits its own, within its time.
    """
    spark = train.sparkSession
    limit = None if budget is None else max(30.0, budget // 16)
    times = Counter(c.preparation for c in candidates if c.preparation)
    ready, lock = {}, Lock()

    def prepared(c: Candidate):
        with lock:
            first = c.preparation not in ready
            made = ready.setdefault(c.preparation, Future())
        if first:
            try:
                stages, rows = c.estimator().prepared(train)
                made.set_result((stages, rows.persist(StorageLevel.MEMORY_AND_DISK)))  # outlier steps score every row
            except BaseException as e:  # the others fail as well
                made.set_exception(e)
        return made.result()

    def fit(c: Candidate):
        chain = c.estimator()
        if budget is not None or times[c.preparation] < 2:
            return chain.fit(train)
        stages, rows = prepared(c)
        return PipelineModel([*stages, chain.regressor.fit(rows)])

    fits = run_limited(spark, [lambda c=c: fit(c) for c in candidates], parallelism, limit, budget)
    for made in ready.values():
        if made.exception() is None:
            made.result()[1].unpersist()

    def scored(i):
        frame = fits[i].value.transform(valid)
        return frame.select(F.lit(i).alias("i"), F.col("label"), F.col("prediction"))

    def score_of(frame):
        return frame.groupBy("i").agg(score_by(metric, "label", "prediction").alias("score")).collect()

    good = [i for i, o in enumerate(fits) if o.status == "ok"]
    found: dict[int, float] = {}
    if good:
        try:
            rows = score_of(reduce(DataFrame.unionAll, [scored(i) for i in good]))
            found = {r["i"]: r["score"] for r in rows}
        except Exception:  # one candidate's predictions fail: find out which
            for i, o in zip(good, run_limited(spark, [lambda i=i: score_of(scored(i)) for i in good], parallelism)):
                if o.status == "ok" and o.value:
                    found[i] = o.value[0]["score"]
                else:
                    fits[i].status, fits[i].error = "failed", o.error
    return [(c, o.status, found.get(i), o.error, o.seconds) for i, (c, o) in enumerate(zip(candidates, fits))]


_TABLE = "ord int, model string, status string, score double, error string, seconds double"


def _table(spark, outcomes) -> DataFrame:
    rows = [(i, c.name, st, None if sc is None else float(sc), err, float(sec)) for i, (c, st, sc, err, sec) in enumerate(outcomes)]
    return leaderboard(spark.createDataFrame(rows, _TABLE))


@dataclass
class PortfolioSearch:
    """Every allowed family with every preparation on a 75/25 split."""

    name: str = "portfolio"
    families: Sequence[str] | None = None
    preparations: Sequence[str | None] = (None,)
    settings: dict[str, dict] = field(default_factory=dict)
    extra: Sequence[Candidate] = ()
    metric: str = "r2"
    parallelism: int = 4
    budget: float | None = None
    seed: int = 42

    def candidates(self) -> list[Candidate]:
        families = clean_names(self.families, MODELS, LIGHT_DEFAULT)
        preps = [p for p in dict.fromkeys(self.preparations) if p is None or p in PREPARATIONS] or [None]
        made = [Candidate(f, p, self.settings.get(f, {})) for f in families for p in preps]
        return [*made, *self.extra]

    def run(self, df: DataFrame, key: Sequence[str]) -> SearchResult:
        split = held(holdout_split(df, key, 0.25, self.seed, out="_valid"))
        try:
            train, valid = split.filter("not _valid").drop("_valid"), split.filter("_valid").drop("_valid")
            outcomes = evaluate_candidates(self.candidates(), train, valid, self.metric, self.parallelism, self.budget)
        finally:
            split.unpersist()
        table = _table(df.sparkSession, outcomes)
        best = champion_row(table, "score")
        chosen = outcomes[best["ord"]][0]
        return SearchResult(table, {"model": chosen.name, **chosen.settings}, best["score"], chosen.estimator())


@dataclass
class RoundSearch:
    """Rounds of mutated candidates around the best so far; stops after ``patience`` rounds without gain."""

    name: str = "rounds"
    families: Sequence[str] | None = None
    preparations: Sequence[str | None] = (None, "StandardScaler")
    population: int = 100
    generations: int = 100
    patience: int = 20
    metric: str = "r2"
    parallelism: int = 4
    budget: float | None = None
    seed: int = 42

    def _random(self, rng, families, preps) -> Candidate:
        family = families[rng.integers(len(families))]
        settings = {k: v[rng.integers(len(v))] for k, v in MUTATIONS[family].items()}
        return Candidate(family, preps[rng.integers(len(preps))], settings)

    def _mutate(self, rng, parent: Candidate, families, preps) -> Candidate:
        what = rng.integers(3)
        if what == 0:
            return Candidate(parent.family, preps[rng.integers(len(preps))], dict(parent.settings))
        if what == 1 or not parent.settings:
            return self._random(rng, families, preps)
        name = list(parent.settings)[rng.integers(len(parent.settings))]
        options = MUTATIONS[parent.family].get(name, [parent.settings[name]])
        return Candidate(parent.family, parent.preparation, {**parent.settings, name: options[rng.integers(len(options))]})

    def run(self, df: DataFrame, key: Sequence[str], evaluate: Callable | None = None) -> SearchResult:
        families = clean_names(self.families, MODELS, LIGHT_DEFAULT)
        preps = [p for p in dict.fromkeys(self.preparations) if p is None or p in PREPARATIONS] or [None]
        rng = np.random.default_rng(self.seed)
        split = None
        if evaluate is None:
            split = held(holdout_split(df, key, 0.25, self.seed, out="_valid"))
            train, valid = split.filter("not _valid").drop("_valid"), split.filter("_valid").drop("_valid")
            evaluate = lambda cs, left: evaluate_candidates(cs, train, valid, self.metric, self.parallelism, left)
        began, seen, outcomes, best, stale = time.monotonic(), set(), [], None, 0
        try:
            for _ in range(self.generations):
                left = None if self.budget is None else self.budget - (time.monotonic() - began)
                if left is not None and left <= 0:
                    break
                batch = []
                for _ in range(self.population * 5):
                    c = self._random(rng, families, preps) if best is None else self._mutate(rng, best[0], families, preps)
                    if c.name not in seen:
                        seen.add(c.name)
                        batch.append(c)
                    if len(batch) == self.population:
                        break
                gained = False
                for o in evaluate(batch, left) if batch else []:
                    outcomes.append(o)
                    if o[2] is not None and o[2] == o[2] and (best is None or o[2] > best[2]):
                        best, gained = o, True
                stale = 0 if gained else stale + 1
                if stale >= self.patience:
                    break
        finally:
            if split is not None:
                split.unpersist()
        table = _table(df.sparkSession, outcomes)
        row = champion_row(table, "score")
        chosen = outcomes[row["ord"]][0]
        return SearchResult(table, {"model": chosen.name, **chosen.settings}, row["score"], chosen.estimator())


@dataclass
class MetaResult:
    """Leaderboard of strategies plus their chosen estimators and fitted models, in canonical order."""

    leaderboard: DataFrame
    champion: str
    estimators: dict
    models: dict
    metrics: dict[str, dict]


_META = ("ord int, model string, status string, r2_mean double, r2_std double, rmse_mean double, rmse_std double, "
         "mae_mean double, mae_std double, duration_seconds double, error string")
_SORT = {"r2": ("r2_mean", 1.0), "neg_mean_squared_error": ("rmse_mean", -1.0), "neg_mean_absolute_error": ("mae_mean", -1.0)}


def meta_search(df: DataFrame, strategies: Sequence, key: Sequence[str], n_splits: int = 5, n_repeats: int = 3,
                metric: str = "r2", parallelism: int = 1, seed: int = 42, budget: float | None = None) -> MetaResult:
    """Run each strategy, cross-validate its choice, pick the champion.

    ``metric`` replaces the strategies' own. A failing strategy is recorded and skipped; when none is left an error is
    raised. The result does not depend on ``parallelism``.
    """
    if metric not in _SORT:
        raise ValueError(f"unsupported metric {metric!r}")
    spark = df.sparkSession
    fold_columns = [f"fold_r{r}" for r in range(n_repeats)]
    table = held(repeated_kfold(df, key, n_splits, n_repeats, seed))

    def job(strategy):
        if is_dataclass(strategy) and any(f.name == "metric" for f in fields(strategy)):
            strategy = replace(strategy, metric=metric)
        found = strategy.run(table, key)
        row = cv_summary(cross_validate(found.estimator, table, fold_columns, strategy.name)).first()
        return found.estimator, found.estimator.fit(table), row.asDict()

    try:
        outcomes = run_limited(spark, [lambda s=s: job(s) for s in strategies], parallelism, budget, None)
        rows, estimators, models, metrics = [], {}, {}, {}
        for i, (s, o) in enumerate(zip(strategies, outcomes)):
            if o.status == "ok":
                estimator, model, m = o.value
                estimators[s.name], models[s.name] = estimator, model
                values = [m[f"{k}_{w}"] for k in ("r2", "rmse", "mae") for w in ("mean", "std")]
                metrics[s.name] = {**{f"{k}_{w}": m[f"{k}_{w}"] for k in ("r2", "rmse", "mae") for w in ("mean", "std")},
                                   "duration_seconds": o.seconds}
            else:
                values = [None] * 6
            rows.append((i, s.name, o.status, *values, float(o.seconds), o.error))
    finally:
        table.unpersist()
    if not models:
        raise RuntimeError("no strategy succeeded: " + "; ".join(f"{s.name}: {o.error}" for s, o in zip(strategies, outcomes)))
    column, sign = _SORT[metric]
    board = leaderboard(spark.createDataFrame(rows, _META).withColumn("score", F.col(column) * F.lit(sign)))
    return MetaResult(board, champion_row(board, "score")["model"], estimators, models, metrics)
