"""Regression families, metrics, cross-validation and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from fitmesh.functions import metrics as M
from fitmesh.models.adaboost import AdaBoost, loss_summary, reweighted
from fitmesh.models.extratrees import ExtraTrees
from fitmesh.models.grouped import fit_by_group, predict_by_group
from fitmesh.models.linear import OLS, ElasticNet, Lasso, Ridge
from fitmesh.models.mlp import MLP
from fitmesh.models.neighbours import KNN
from fitmesh.models.svr import SVR
from fitmesh.models.boosting import LightGBM, XGBoost
from fitmesh.models.trees import DecisionTree, GradientBoosting, RandomForest
from fitmesh.operators.splits import holdout_split, repeated_kfold
from fitmesh.plans.chain import Chain
from fitmesh.plans.crossval import cross_validate, cross_validate_keep_best, cross_validate_summary
from fitmesh.plans.search import Candidate, PortfolioSearch, RoundSearch, meta_search, random_search
from fitmesh.plans.selection import leaderboard, select_champion
from fitmesh.queries.data import exact_folds_sql
from fitmesh.queries.registry import LI, hash_sql, lines, metrics_sql, query, rounded, table, with_features

FOLDS = ["fold_r0", "fold_r1", "fold_r2"]
ALL = ["qty", "price", "disc", "tax"]
SCORES = {"r2": 8, "rmse": 4, "mae": 4}
SUMMARY = {"r2_mean": 8, "r2_std": 8, "rmse_mean": 4, "rmse_std": 4, "mae_mean": 4, "mae_std": 4}


def scores_sql(r2="r2", rmse="rmse", mae="mae") -> str:
    return f"round({r2}, 8) AS r2, round({rmse}, 4) AS rmse, round({mae}, 4) AS mae"


SUMMARY_SQL = ", ".join(f"round({f}({m}), {SUMMARY[f'{m}_{s}']}) AS {m}_{s}" for m in ("r2", "rmse", "mae")
                        for s, f in (("mean", "avg"), ("std", "stddev_pop")))

# out-of-fold predictions of one-feature least squares: sums of the training rows are total - fold
FAST_FOLDS = f"folds AS (SELECT id, r AS repeat, CAST(('0x' || substr(md5(concat_ws(':', '42', r, id)), 1, 15))::BIGINT % 5 AS INTEGER) AS fold FROM li, range(3) t(r))"


_CENTRE = {"price": 50000, "qty": 25, "disc": 0.05}  # keeps the SQL sums well conditioned


def oof_sql(x: str, name: str, alpha: str = "0.0", source: str = "li") -> str:
    """CTEs ``{name}_fit`` and ``{name}`` (id, repeat, fold, label, prediction) for label ~ x with an L2 penalty."""
    c = _CENTRE[x]
    return f"""{name}_g AS (SELECT repeat, fold, count(*) AS n, sum({x} - {c}) AS sx, sum(label - 50000) AS sy, sum(({x} - {c}) * ({x} - {c})) AS sxx,
  sum(({x} - {c}) * (label - 50000)) AS sxy FROM {source} JOIN folds USING (id) GROUP BY repeat, fold),
{name}_t AS (SELECT repeat, sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, sum(sxx) AS sxx, sum(sxy) AS sxy FROM {name}_g GROUP BY repeat),
{name}_d AS (SELECT g.repeat, g.fold, t.n - g.n AS n, t.sx - g.sx AS sx, t.sy - g.sy AS sy, t.sxx - g.sxx AS sxx, t.sxy - g.sxy AS sxy
  FROM {name}_g g JOIN {name}_t t USING (repeat)),
{name}_fit AS (SELECT repeat, fold, (sxy - sx * sy / n) / (sxx - sx * sx / n + {alpha}) AS w, {c} + sx / n AS mx, 50000 + sy / n AS my FROM {name}_d),
{name} AS (SELECT id, repeat, fold, label, my + w * ({x} - mx) AS prediction FROM {source} JOIN folds USING (id) JOIN {name}_fit USING (repeat, fold))"""


def fold_scores_sql(name: str) -> str:
    return f"SELECT repeat, fold, count(*) AS n, {metrics_sql('label', 'prediction')} FROM {name} GROUP BY repeat, fold"


def folded(spark, sf_dir, columns, mode="exact"):
    v = with_features(lines(spark, sf_dir), columns, "id")
    return repeated_kfold(v, ["id"], 5, 3, mode=mode)


def split_rows(spark, sf_dir, columns):
    s = holdout_split(with_features(lines(spark, sf_dir), columns, "id"), ["id"])
    return s.filter("not is_test").drop("is_test"), s.filter("is_test").drop("is_test")


# --------------------------------------------------------------------------- cross-validation


@query("ols_repeated_cv", f"""
WITH {LI}, {FAST_FOLDS}, {oof_sql('price', 'p')}, s AS ({fold_scores_sql('p')})
SELECT 'OLS' AS model, {SUMMARY_SQL} FROM s""")
def ols_repeated_cv(spark, sf_dir):
    """The flagship: 15 fits and 15 scores from two scans and no shuffle of rows."""
    return rounded(cross_validate_summary(OLS(), folded(spark, sf_dir, ["price"], "fast"), FOLDS), SUMMARY)


@query("fold_scores", f"""
WITH {LI}, {exact_folds_sql(5, 3)}, {oof_sql('price', 'p')}, s AS ({fold_scores_sql('p')})
SELECT 'OLS' AS model, repeat, fold, n, {scores_sql()} FROM s""")
def fold_scores_query(spark, sf_dir):
    return rounded(cross_validate(OLS(), folded(spark, sf_dir, ["price"]), FOLDS), SCORES)


@query("cv_summary", f"""
WITH {LI}, {exact_folds_sql(5, 3)}, {oof_sql('price', 'p', '1e9')}, s AS ({fold_scores_sql('p')})
SELECT 'Ridge' AS model, {SUMMARY_SQL} FROM s""")
def cv_summary_query(spark, sf_dir):
    return rounded(cross_validate_summary(Ridge(alpha=1e9), folded(spark, sf_dir, ["price"]), FOLDS), SUMMARY)


@query("scaled_chain_cv", f"""
WITH {LI}, {exact_folds_sql(5, 3)}, {oof_sql('price', 'p')}, s AS ({fold_scores_sql('p')})
SELECT 'StandardScale+OLS' AS model, {SUMMARY_SQL} FROM s""")
def scaled_chain_cv(spark, sf_dir):
    """Scaling is refitted per fold, from the same sums as the regression."""
    from fitmesh.operators.scale import StandardScale

    chain = Chain([StandardScale()], OLS())
    return rounded(cross_validate_summary(chain, folded(spark, sf_dir, ["price"]), FOLDS, chain.name), SUMMARY)


@query("best_fold_model", f"""
WITH {LI}, {exact_folds_sql(5, 1)}, {oof_sql('price', 'p')}, s AS ({fold_scores_sql('p')})
SELECT repeat, fold, round(r2, 8) AS r2, round(w, 8) AS slope, round(my - w * mx, 4) AS intercept FROM s JOIN p_fit USING (repeat, fold)
ORDER BY s.r2 DESC LIMIT 1""")
def best_fold_model(spark, sf_dir):
    v = repeated_kfold(with_features(lines(spark, sf_dir), ["price"], "id"), ["id"], 5, 1)
    model, scores = cross_validate_keep_best(OLS(), v, ["fold_r0"])
    top = scores.orderBy(F.desc("r2")).limit(1)
    return top.select("repeat", "fold", F.round("r2", 8).alias("r2"), F.round(F.lit(float(model.state["coefficients"][0])), 8).alias("slope"),
                      F.round(F.lit(float(model.state["intercept"])), 4).alias("intercept"))


@query("forest_cv")
def forest_cv(spark, sf_dir):
    """A family without a closed form: refitted per fold, scored in one aggregation."""
    v = repeated_kfold(with_features(lines(spark, sf_dir), ALL, "id"), ["id"], 3, 1)
    return cross_validate(RandomForest(n_estimators=5, max_depth=5), v, ["fold_r0"])


# --------------------------------------------------------------------------- least squares


@query("ols_regression", f"""
WITH {LI} SELECT round(regr_slope(label, price), 8) AS slope, round(regr_intercept(label, price), 4) AS intercept,
  round(regr_r2(label, price), 8) AS r2 FROM li""")
def ols_regression(spark, sf_dir):
    v = with_features(lines(spark, sf_dir), ["price"])
    m = OLS().fit(v)
    return m.transform(v).agg(F.round(F.lit(float(m.state["coefficients"][0])), 8).alias("slope"),
                              F.round(F.lit(float(m.state["intercept"])), 4).alias("intercept"),
                              F.round(M.r2("label", "prediction"), 8).alias("r2"))


def _two_feature_sql(alpha: str) -> str:
    return f"""WITH {LI}, m AS (SELECT count(*) AS n, avg(price) AS mp, avg(disc) AS md, avg(label) AS my FROM li),
c AS (SELECT any_value(mp) AS mp, any_value(md) AS md, any_value(my) AS my, sum((price - mp) * (price - mp)) + {alpha} AS a,
  sum((price - mp) * (disc - md)) AS b, sum((disc - md) * (disc - md)) + {alpha} AS d, sum((price - mp) * (label - my)) AS e,
  sum((disc - md) * (label - my)) AS f FROM li, m),
w AS (SELECT *, (e * d - b * f) / (a * d - b * b) AS w1, (a * f - b * e) / (a * d - b * b) AS w2 FROM c)
SELECT round(w1, 8) AS price, round(w2, 3) AS disc, round(my - w1 * mp - w2 * md, 3) AS intercept FROM w"""


def _coefficients(spark, model, names, digits):
    w = [float(x) for x in model.state["coefficients"]]
    row = [(*w, float(model.state["intercept"]))]
    df = spark.createDataFrame(row, ", ".join(f"{n} double" for n in [*names, "intercept"]))
    return rounded(df, digits)


@query("ols_two_features", _two_feature_sql("0.0"))
def ols_two_features(spark, sf_dir):
    m = OLS().fit(with_features(lines(spark, sf_dir), ["price", "disc"]))
    return _coefficients(spark, m, ["price", "disc"], {"price": 8, "disc": 3, "intercept": 3})


@query("ridge_regression", _two_feature_sql("10.0"))
def ridge_regression(spark, sf_dir):
    m = Ridge(alpha=10.0).fit(with_features(lines(spark, sf_dir), ["price", "disc"]))
    return _coefficients(spark, m, ["price", "disc"], {"price": 8, "disc": 3, "intercept": 3})


def _soft_sql(l1: str, l2: str) -> str:
    return f"""WITH {LI}, c AS (SELECT covar_pop(label, tax) AS c, var_pop(tax) AS v, avg(label) AS my, avg(tax) AS mx FROM li),
w AS (SELECT *, sign(c) * greatest(abs(c) - {l1}, 0) / (v + {l2}) AS w FROM c) SELECT round(w, 4) AS tax, round(my - w * mx, 4) AS intercept FROM w"""


@query("lasso_regression", _soft_sql("5.0", "0.0"))
def lasso_regression(spark, sf_dir):
    m = Lasso(alpha=5.0).fit(with_features(lines(spark, sf_dir), ["tax"]))
    return _coefficients(spark, m, ["tax"], {"tax": 4, "intercept": 4})


@query("elastic_net_regression", _soft_sql("0.01 * 0.3", "0.01 * 0.7"))
def elastic_net_regression(spark, sf_dir):
    m = ElasticNet(alpha=0.01, l1_ratio=0.3).fit(with_features(lines(spark, sf_dir), ["tax"]))
    return _coefficients(spark, m, ["tax"], {"tax": 4, "intercept": 4})


@query("predict_rows", f"""
WITH {LI}, w AS (SELECT regr_slope(label, price) AS w, regr_intercept(label, price) AS b FROM li)
SELECT id, round(price * w + b, 2) AS prediction FROM li, w""")
def predict_rows(spark, sf_dir):
    v = with_features(lines(spark, sf_dir), ["price"], "id")
    return OLS().fit(v).transform(v).select("id", F.round("prediction", 2).alias("prediction"))


@query("weighted_r2", f"""
WITH {LI}, m AS (SELECT sum(qty * label) / sum(qty) AS my FROM li)
SELECT round(1 - sum(qty * pow(label - price, 2)) / sum(qty * pow(label - my, 2)), 8) AS r2 FROM li, m""")
def weighted_r2_query(spark, sf_dir):
    li = lines(spark, sf_dir)
    return li.agg(F.round(M.weighted_r2("label", "price", "qty", 50000.0), 8).alias("r2"))


@query("grouped_regression", f"""
WITH {LI} SELECT l_returnflag, l_linestatus, count(*) AS n, round(regr_slope(label, price), 8) AS slope, round(regr_intercept(label, price), 4) AS intercept,
  round(regr_r2(label, price), 8) AS r2 FROM li GROUP BY l_returnflag, l_linestatus""")
def grouped_regression(spark, sf_dir):
    fits = fit_by_group(lines(spark, sf_dir, "l_returnflag", "l_linestatus"), ["l_returnflag", "l_linestatus"], ["price"], "label")
    return fits.select("l_returnflag", "l_linestatus", "n", F.round(F.col("coefficients")[0], 8).alias("slope"),
                       F.round("intercept", 4).alias("intercept"), F.round("r2", 8).alias("r2"))


@query("grouped_prediction", f"""
WITH {LI}, w AS (SELECT l_suppkey, regr_slope(label, price) AS w, regr_intercept(label, price) AS b FROM li GROUP BY l_suppkey),
p AS (SELECT label, price * w + b AS prediction FROM li JOIN w USING (l_suppkey))
SELECT count(*) AS n, {scores_sql(*['1 - sum(pow(label - prediction, 2)) / (count(*) * var_pop(label))', 'sqrt(avg(pow(label - prediction, 2)))', 'avg(abs(label - prediction))'])} FROM p""")
def grouped_prediction(spark, sf_dir):
    li = lines(spark, sf_dir, "l_suppkey")
    fits = fit_by_group(li, ["l_suppkey"], ["price"], "label")
    return rounded(M.evaluate(predict_by_group(li, fits, ["l_suppkey"], ["price"])), SCORES)


# --------------------------------------------------------------------------- trees and other families


@query("decision_tree_stump", f"""
WITH {LI}, g AS (SELECT disc, count(*) AS n, sum(label) AS s FROM li GROUP BY disc),
c AS (SELECT disc, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s FROM g WINDOW w AS (ORDER BY disc)),
b AS (SELECT disc AS cut, sl / nl AS lo, (s - sl) / (n - nl) AS hi FROM c WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)
SELECT id, round(CASE WHEN disc <= cut THEN lo ELSE hi END, 2) AS prediction FROM li, b""")
def decision_tree_stump(spark, sf_dir):
    v = with_features(lines(spark, sf_dir), ["disc"], "id")
    return DecisionTree(max_depth=1).fit(v).transform(v).select("id", F.round("prediction", 2).alias("prediction"))


_STUMP = f"""{LI}, g AS (SELECT disc, count(*) AS n, sum(label) AS s FROM li GROUP BY disc),
c AS (SELECT disc, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s FROM g WINDOW w AS (ORDER BY disc)),
b AS (SELECT disc AS cut, sl / nl AS lo, (s - sl) / (n - nl) AS hi FROM c WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1),
f AS (SELECT id, disc, label, CASE WHEN disc <= cut THEN lo ELSE hi END AS p1 FROM li, b)"""


def _stump(name, estimator):
    """One split on few distinct values has a closed form in every tree family."""
    @query(name, f"WITH {_STUMP} SELECT id, round(p1, 2) AS prediction FROM f")
    def run(spark, sf_dir):
        v = with_features(lines(spark, sf_dir), ["disc"], "id")
        return estimator().fit(v).transform(v).select("id", F.round("prediction", 2).alias("prediction"))

    return run


_stump("random_forest_stump", lambda: RandomForest(n_estimators=1, max_depth=1, bootstrap=False))
_stump("xgboost_stump", lambda: XGBoost(n_estimators=1, max_depth=1, learning_rate=1.0, reg_lambda=0.0))
_stump("lightgbm_stump", lambda: LightGBM(n_estimators=1, num_leaves=2, learning_rate=1.0))
_stump("adaboost_stump", lambda: AdaBoost(n_estimators=1, max_depth=1, resample=False))


@query("gradient_boosting_two_rounds", f"""
WITH {_STUMP}, g2 AS (SELECT disc, count(*) AS n, sum(label - p1) AS s FROM f GROUP BY disc),
c2 AS (SELECT disc, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS n, sum(s) OVER () AS s FROM g2 WINDOW w AS (ORDER BY disc)),
b2 AS (SELECT disc AS cut, sl / nl AS lo, (s - sl) / (n - nl) AS hi FROM c2 WHERE nl < n ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC LIMIT 1)
SELECT id, round(p1 + 0.5 * CASE WHEN disc <= cut THEN lo ELSE hi END, 2) AS prediction FROM f, b2""")
def gradient_boosting_two_rounds(spark, sf_dir):
    v = with_features(lines(spark, sf_dir), ["disc"], "id")
    m = GradientBoosting(n_estimators=2, max_depth=1, learning_rate=0.5).fit(v)
    return m.transform(v).select("id", F.round("prediction", 2).alias("prediction"))


def _best_split_sql(name: str, source: str, penalty: float, least: int = 1, group: str = "") -> str:
    """Best split (column, cut, gain, leaf values) of the residuals ``r`` of a relation, for each value of ``group``."""
    by = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    sides = " UNION ALL ".join(f"SELECT {by}'{c}' AS col, {c} AS cut, count(*) AS n, sum(r) AS s FROM {source} GROUP BY {by}{c}" for c in ("disc", "tax"))
    score = f"sl * sl / (nl + {penalty}) + (s - sl) * (s - sl) / (n - nl + {penalty}) - s * s / (n + {penalty})"
    return f"""{name} AS (SELECT {by}col, cut, {score} AS gain, sl / (nl + {penalty}) AS lo, (s - sl) / (n - nl + {penalty}) AS hi
  FROM (SELECT {by}col, cut, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER v AS n, sum(s) OVER v AS s FROM ({sides}) t
    WINDOW w AS (PARTITION BY {by}col ORDER BY cut), v AS (PARTITION BY {by}col)) t
  WHERE nl >= {least} AND n - nl >= {least} QUALIFY row_number() OVER ({part} ORDER BY gain DESC) = 1)"""


def _goes(b: str, value_low: str, value_high: str) -> str:
    return f"CASE WHEN CASE {b}.col WHEN 'disc' THEN disc ELSE tax END <= {b}.cut THEN {value_low} ELSE {value_high} END"


@query("xgboost_two_rounds", f"""
WITH {LI}, r0 AS (SELECT id, disc, tax, label, avg(label) OVER () AS m, label - avg(label) OVER () AS r FROM li), {_best_split_sql("b1", "r0", 1.0)},
r1 AS (SELECT id, disc, tax, label, m + 0.3 * {_goes("b1", "b1.lo", "b1.hi")} AS m, label - (m + 0.3 * {_goes("b1", "b1.lo", "b1.hi")}) AS r FROM r0, b1), {_best_split_sql("b2", "r1", 1.0)}
SELECT id, round(m + 0.3 * {_goes("b2", "b2.lo", "b2.hi")}, 2) AS prediction FROM r1, b2""")
def xgboost_two_rounds(spark, sf_dir):
    """Two stumps at the default rate and penalty."""
    v = with_features(lines(spark, sf_dir), ["disc", "tax"], "id")
    m = XGBoost(n_estimators=2, max_depth=1).fit(v)
    return m.transform(v).select("id", F.round("prediction", 2).alias("prediction"))


@query("lightgbm_three_leaves", f"""
WITH {LI}, r0 AS (SELECT id, disc, tax, label, avg(label) OVER () AS m, label - avg(label) OVER () AS r FROM li), {_best_split_sql("b1", "r0", 0.0, 20)},
r1 AS (SELECT r0.*, {_goes("b1", "0", "1")} AS side FROM r0, b1), {_best_split_sql("b2", "r1", 0.0, 20, "side")},
o AS (SELECT * FROM b2 ORDER BY gain DESC LIMIT 1)
SELECT id, round(m + CASE WHEN r1.side = o.side THEN {_goes("o", "o.lo", "o.hi")} ELSE CASE r1.side WHEN 0 THEN b1.lo ELSE b1.hi END END, 2) AS prediction FROM r1, b1, o""")
def lightgbm_three_leaves(spark, sf_dir):
    """One leaf-wise tree: only the side with the larger gain is split again."""
    v = with_features(lines(spark, sf_dir), ["disc", "tax"], "id")
    m = LightGBM(n_estimators=1, num_leaves=3, learning_rate=1.0).fit(v)
    return m.transform(v).select("id", F.round("prediction", 2).alias("prediction"))


@query("decision_tree_two_levels", f"""
WITH {LI}, r0 AS (SELECT id, disc, tax, label AS r, avg(label) OVER () AS m FROM li), {_best_split_sql("b1", "r0", 0.0)},
r1 AS (SELECT r0.*, {_goes("b1", "0", "1")} AS side FROM r0, b1), {_best_split_sql("b2", "r1", 0.0, 1, "side")}
SELECT id, round({_goes("b2", "b2.lo", "b2.hi")}, 2) AS prediction FROM r1 JOIN b2 USING (side)""")
def decision_tree_two_levels(spark, sf_dir):
    v = with_features(lines(spark, sf_dir), ["disc", "tax"], "id")
    return DecisionTree(max_depth=2).fit(v).transform(v).select("id", F.round("prediction", 2).alias("prediction"))


@query("extra_trees_two_values", f"""
WITH {LI} SELECT id, round(avg(label) OVER (PARTITION BY l_returnflag = 'R'), 2) AS prediction FROM li""")
def extra_trees_two_values(spark, sf_dir):
    """Any random threshold separates two values, so every tree predicts the two means."""
    li = lines(spark, sf_dir, "l_returnflag").withColumn("flag", (F.col("l_returnflag") == "R").cast("double"))
    v = with_features(li, ["flag"], "id")
    return ExtraTrees(n_estimators=3, max_depth=2).fit(v).transform(v).select("id", F.round("prediction", 2).alias("prediction"))


@query("mlp_linear_limit", f"""
WITH {LI} SELECT count(*) AS n, round(regr_r2(label, price), 6) AS r2 FROM li""")
def mlp_linear_limit(spark, sf_dir):
    """Without hidden units and penalty the network is least squares."""
    v = with_features(lines(spark, sf_dir), ["price"])
    m = MLP(hidden_layer_sizes=[], activation="identity", solver="lbfgs", alpha=0.0, tol=1e-9).fit(v)
    return m.transform(v).agg(F.count(F.lit(1)).alias("n"), F.round(M.r2("label", "prediction"), 6).alias("r2"))


def _scored(name, estimator, columns=ALL, scale=False):
    @query(name)
    def run(spark, sf_dir):
        """Fitted on the training rows, scored on the hold-out."""
        from fitmesh.operators.scale import StandardScale

        train, test = split_rows(spark, sf_dir, columns)
        if scale:
            s = StandardScale().fit(train)
            train, test = s.transform(train), s.transform(test)
        return rounded(M.evaluate(estimator().fit(train).transform(test)), SCORES)

    return run


_scored("decision_tree", lambda: DecisionTree(max_depth=8))
_scored("random_forest", lambda: RandomForest(n_estimators=10, max_depth=6, max_features="sqrt"))
_scored("extra_trees", lambda: ExtraTrees(n_estimators=10, max_depth=6))
_scored("gradient_boosting", lambda: GradientBoosting(n_estimators=10, max_depth=4, learning_rate=0.3))
_scored("xgboost_preset", lambda: XGBoost(n_estimators=5, max_depth=5, subsample=0.8))
_scored("lightgbm_preset", lambda: LightGBM(n_estimators=5, num_leaves=31))
_scored("adaboost", lambda: AdaBoost(n_estimators=4))
_scored("svr_linear", lambda: SVR(kernel="linear", C=100.0, max_iter=10), scale=True)
_scored("svr_rbf", lambda: SVR(C=100.0, n_components=128, max_iter=8), scale=True)
_scored("mlp", lambda: MLP(hidden_layer_sizes=[16], max_iter=25))


@query("adaboost_reweighting", f"""
WITH {LI}, p AS (SELECT id, label, avg(label) OVER (PARTITION BY qty) AS prediction FROM li),
d AS (SELECT max(abs(label - prediction)) AS top FROM p), l AS (SELECT any_value(top) AS top, avg(abs(label - prediction) / top) AS loss FROM p, d)
SELECT id, round(pow(loss / (1 - loss), 1 - abs(label - prediction) / top), 6) AS weight FROM p, l""")
def adaboost_reweighting(spark, sf_dir):
    """One boosting step for fixed predictions (the mean label per quantity)."""
    li = lines(spark, sf_dir)
    means = li.groupBy("qty").agg(F.avg("label").alias("prediction"))
    p = li.join(means, "qty").withColumn("w", F.lit(1.0))
    top, loss = loss_summary(p, "label", "prediction", "w")
    return p.select("id", F.round(reweighted("label", "prediction", "w", top, loss, 1.0), 6).alias("weight"))


def _knn_sql(weights: str) -> str:
    value = "avg(label)" if weights == "uniform" else "sum(label / d) / sum(1 / d)"
    return f"""WITH r AS (SELECT vec_id, embedding::DOUBLE[] AS e, label, row_number() OVER (ORDER BY {hash_sql(42, key='vec_id')}) - 1 AS r, count(*) OVER () AS n FROM embeddings),
q AS (SELECT * FROM r WHERE r < ceil(0.2 * n)), b AS (SELECT * FROM r WHERE NOT r < ceil(0.2 * n)),
d AS (SELECT q.vec_id, b.label, list_distance(q.e, b.e) AS d, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.e, b.e), b.vec_id) AS k FROM q, b)
SELECT vec_id, round({value}, 6) AS prediction FROM d WHERE k <= 5 GROUP BY vec_id"""


def _knn(spark, sf_dir, weights):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("features"), F.col("label").cast("double").alias("label"))
    s = holdout_split(e, ["vec_id"])
    model = KNN(n_neighbors=5, weights=weights, idCol="vec_id").fit(s.filter("not is_test"))
    return model.transform(s.filter("is_test")).select("vec_id", F.round("prediction", 6).alias("prediction"))


@query("knn_regression", _knn_sql("uniform"))
def knn_regression(spark, sf_dir):
    return _knn(spark, sf_dir, "uniform")


@query("knn_regression_distance", _knn_sql("distance"))
def knn_regression_distance(spark, sf_dir):
    return _knn(spark, sf_dir, "distance")


# --------------------------------------------------------------------------- metrics


@query("regression_metrics", f"""
WITH {LI} SELECT count(*) AS n, {scores_sql('1 - sum(pow(label - price, 2)) / (count(*) * var_pop(label))', 'sqrt(avg(pow(label - price, 2)))', 'avg(abs(label - price))')} FROM li""")
def regression_metrics(spark, sf_dir):
    return rounded(M.evaluate(lines(spark, sf_dir), "label", "price"), SCORES)


@query("metric_scores", f"""
WITH {LI}, s AS (SELECT {metrics_sql('label', 'price')}, avg(pow(label - price, 2)) AS mse FROM li)
SELECT 'r2' AS metric, round(r2, 8) AS score FROM s UNION ALL SELECT 'neg_mean_squared_error', round(-mse / 1e3, 4) FROM s
UNION ALL SELECT 'neg_mean_absolute_error', round(-mae / 1e3, 6) FROM s""")
def metric_scores(spark, sf_dir):
    one = lines(spark, sf_dir).agg(*[M.score(m, "label", "price").alias(m) for m in M.METRICS])
    unit = {"r2": (1.0, 8), "neg_mean_squared_error": (1e3, 4), "neg_mean_absolute_error": (1e3, 6)}
    return one.select(F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.round(F.col(m) / u, d).alias("score"))
                                         for m, (u, d) in unit.items()])))


HOLDOUT = f"""{LI}, r AS (SELECT *, row_number() OVER (ORDER BY {hash_sql(42)}) - 1 AS r, count(*) OVER () AS n FROM li),
tr AS (SELECT * FROM r WHERE NOT r < ceil(0.2 * n)), te AS (SELECT * FROM r WHERE r < ceil(0.2 * n)),
w AS (SELECT regr_slope(label, price) AS wp, regr_intercept(label, price) AS bp, regr_slope(label, qty) AS wq, regr_intercept(label, qty) AS bq FROM tr)"""


@query("holdout_metrics", f"""
WITH {HOLDOUT}, p AS (SELECT label, price * wp + bp AS prediction FROM te, w), s AS (SELECT count(*) AS n, {metrics_sql('label', 'prediction')} FROM p)
SELECT n, {scores_sql()} FROM s""")
def holdout_metrics(spark, sf_dir):
    train, test = split_rows(spark, sf_dir, ["price"])
    return rounded(M.evaluate(OLS().fit(train).transform(test)), SCORES)


# --------------------------------------------------------------------------- search


_ALPHAS = [0.0, 1e12, 1e13, 1e14]


@query("random_search_ridge", f"""
WITH {LI}, {exact_folds_sql(5, 2)}, """ + ", ".join(oof_sql('price', f'a{i}', repr(a)) for i, a in enumerate(_ALPHAS)) + ", s AS (" + " UNION ALL ".join(
    f"SELECT 'alpha={a}' AS params, * FROM ({fold_scores_sql(f'a{i}')})" for i, a in enumerate(_ALPHAS)) + """)
SELECT params, round(avg(r2), 8) AS score, round(stddev_pop(r2), 8) AS score_std, CAST(row_number() OVER (ORDER BY avg(r2) DESC) AS INTEGER) AS rank FROM s GROUP BY params""")
def random_search_ridge(spark, sf_dir):
    """All candidates share one pass of sums and one pass of predictions."""
    found = random_search(with_features(lines(spark, sf_dir), ["price"], "id"), Ridge, {"alpha": _ALPHAS}, 4, key=["id"], refit=False)
    return rounded(found.table.select("params", "score", "score_std", "rank"), {"score": 8, "score_std": 8})


@query("random_search_forest")
def random_search_forest(spark, sf_dir):
    grid = {"n_estimators": [3, 5], "max_depth": [3, 5], "min_samples_split": [2, 5], "max_features": ["sqrt", "log2", None]}
    found = random_search(with_features(lines(spark, sf_dir), ALL, "id"), RandomForest, grid, 2, key=["id"], n_splits=3, n_repeats=1)
    return found.table


INNER = f"""{LI}, r AS (SELECT *, row_number() OVER (ORDER BY {hash_sql(42)}) - 1 AS r, count(*) OVER () AS n FROM li),
tr AS (SELECT * FROM r WHERE NOT r < ceil(0.25 * n)), te AS (SELECT * FROM r WHERE r < ceil(0.25 * n)),
c AS (SELECT covar_pop(label, price) AS c, var_pop(price) AS v, avg(label) AS my, avg(price) AS mx, count(*) AS m FROM tr)"""
_PORTFOLIO = [("Ridge(alpha=10000000000000.0)", "c * m / (v * m + 1e13)"), ("Lasso(alpha=100000000.0)", "(c - 1e8) / v"), ("OLS", "c / v")]


@query("portfolio_search", f"WITH {INNER}, p AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS model, {i} AS ord, label, my + ({w}) * (price - mx) AS prediction FROM te, c" for i, (n, w) in enumerate(_PORTFOLIO)) + """),
s AS (SELECT model, ord, 1 - sum(pow(label - prediction, 2)) / (count(*) * var_pop(label)) AS r2 FROM p GROUP BY model, ord)
SELECT CAST(row_number() OVER (ORDER BY r2 DESC, ord) AS INTEGER) AS rank, model, 'ok' AS status, round(r2, 8) AS score FROM s
UNION ALL SELECT 4, 'Broken', 'failed', NULL""")
def portfolio_search(spark, sf_dir):
    """Unknown names are dropped, a failing candidate is recorded, the rest are ranked on the 75/25 split."""
    def broken():
        raise RuntimeError("a user's stage that cannot be built")

    search = PortfolioSearch(families=["Ridge", "NoSuchModel", "Lasso", "OLS", "Ridge"],
                             settings={"Ridge": {"alpha": 1e13}, "Lasso": {"alpha": 1e8}}, extra=[Candidate("Broken", maker=broken)])
    found = search.run(with_features(lines(spark, sf_dir), ["price"], "id"), ["id"])
    return rounded(found.table.select("rank", "model", "status", "score"), {"score": 8})


@query("portfolio_families")
def portfolio_families(spark, sf_dir):
    """Tree and boosting families at their defaults, with a scaler and an outlier step."""
    search = PortfolioSearch(families=["Ridge", "DecisionTree", "GradientBoosting"], preparations=[None, "StandardScaler", "IsolationForest"])
    found = search.run(with_features(lines(spark, sf_dir), ALL, "id"), ["id"])
    return rounded(found.table.select("rank", "model", "status", "score"), {"score": 6})


@query("round_search_least_squares", f"""
WITH {INNER}, p AS (SELECT label, my + c / v * (price - mx) AS prediction FROM te, c),
s AS (SELECT round(1 - sum(pow(label - prediction, 2)) / (count(*) * var_pop(label)), 8) AS score FROM p)
SELECT 'OLS' AS model, 'ok' AS status, score FROM s UNION ALL SELECT 'StandardScaler+OLS', 'ok', score FROM s""")
def round_search_least_squares(spark, sf_dir):
    """Both reachable candidates are tried once; scaling does not change least squares."""
    found = RoundSearch(families=["OLS"], population=4, generations=3, patience=1).run(
        with_features(lines(spark, sf_dir), ["price"], "id"), ["id"])
    return rounded(found.table.select("model", "status", "score"), {"score": 8})


@query("round_search")
def round_search(spark, sf_dir):
    """The default search: 100 candidates in each of 100 rounds, 20 without gain end it; three families have 64 in all."""
    found = RoundSearch(families=["Ridge", "ElasticNet", "DecisionTree"]).run(with_features(lines(spark, sf_dir), ALL, "id"), ["id"])
    return rounded(found.table.select("rank", "model", "status", "score"), {"score": 6})


@query("meta_search", f"""
WITH {LI}, {exact_folds_sql(5, 3)}, {oof_sql('price', 'a', '1e13')}, {oof_sql('price', 'b')},
s AS (SELECT 'ridge' AS model, * FROM ({fold_scores_sql('a')}) UNION ALL SELECT 'least_squares', * FROM ({fold_scores_sql('b')})),
m AS (SELECT model, 'ok' AS status, {SUMMARY_SQL} FROM s GROUP BY model)
SELECT CAST(row_number() OVER (ORDER BY r2_mean DESC) AS INTEGER) AS rank, * FROM m
UNION ALL SELECT 3, 'broken', 'failed', NULL, NULL, NULL, NULL, NULL, NULL""")
def meta_search_query(spark, sf_dir):
    """Strategies side by side; a failing one is recorded and skipped."""
    class Broken:
        name = "broken"

        def run(self, df, key):
            raise RuntimeError("no candidate")

    strategies = [PortfolioSearch(name="ridge", families=["Ridge"], settings={"Ridge": {"alpha": 1e13}}), Broken(),
                  PortfolioSearch(name="least_squares", families=["OLS"])]
    found = meta_search(with_features(lines(spark, sf_dir), ["price"], "id"), strategies, ["id"], parallelism=3)
    return rounded(found.leaderboard.select("rank", "model", "status", *SUMMARY), SUMMARY)


_FEATURES = ["price", "qty", "disc"]
_PER_FEATURE = ", ".join(oof_sql(f, f"m_{f}") for f in _FEATURES) + ", s AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS model, {i} AS ord, * FROM ({fold_scores_sql(f'm_{f}')})" for i, f in enumerate(_FEATURES)) + (
    "), b AS (SELECT model, ord, avg(r2) AS r2_mean FROM s GROUP BY model, ord UNION ALL SELECT 'undefined', -1, 'nan'::DOUBLE)")


def _feature_board(spark, sf_dir):
    """Cross-validated one-feature models, plus one whose score is undefined."""
    scores = None
    li = lines(spark, sf_dir)
    for i, f in enumerate(_FEATURES):
        v = repeated_kfold(with_features(li, [f], "id"), ["id"], 5, 3, mode="fast")
        part = cross_validate_summary(OLS(), v, FOLDS, f).select("model", F.lit(i).alias("ord"), "r2_mean")
        scores = part if scores is None else scores.unionAll(part)
    nan = li.agg(F.lit("undefined").alias("model"), F.lit(-1).alias("ord"), F.lit(float("nan")).alias("r2_mean"))
    return scores.unionAll(nan)


@query("champion_selection", f"""
WITH {LI}, {FAST_FOLDS}, {_PER_FEATURE} SELECT model, round(r2_mean, 8) AS r2_mean FROM b WHERE NOT isnan(r2_mean) ORDER BY r2_mean DESC, ord LIMIT 1""")
def champion_selection(spark, sf_dir):
    return rounded(select_champion(_feature_board(spark, sf_dir)).select("model", "r2_mean"), {"r2_mean": 8})


@query("leaderboard", f"""
WITH {LI}, {FAST_FOLDS}, {_PER_FEATURE} SELECT CAST(row_number() OVER (ORDER BY CASE WHEN isnan(r2_mean) THEN NULL ELSE r2_mean END DESC NULLS LAST, ord) AS INTEGER) AS rank,
  model, round(CASE WHEN isnan(r2_mean) THEN NULL ELSE r2_mean END, 8) AS r2_mean FROM b""")
def leaderboard_query(spark, sf_dir):
    board = leaderboard(_feature_board(spark, sf_dir), "r2_mean")
    return board.select("rank", "model", F.round(F.nanvl("r2_mean", F.lit(None)), 8).alias("r2_mean"))
