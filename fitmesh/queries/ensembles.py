"""Blends, promotion, stacking and side-by-side comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from fitmesh.functions.vectors import assemble
from fitmesh.models.linear import OLS
from fitmesh.operators.splits import holdout_split, repeated_kfold
from fitmesh.plans.crossval import out_of_fold
from fitmesh.plans.ensemble import compare_engines, linear_stack, mean_blend, predict_all, promote_if_better
from fitmesh.queries.data import exact_folds_sql
from fitmesh.queries.models import HOLDOUT, SCORES, oof_sql, scores_sql
from fitmesh.queries.registry import LI, lines, metrics_sql, query, rounded


def _two_models(spark, sf_dir):
    """Least squares on price and on quantity, fitted on the training rows; hold-out predictions ``p0``, ``p1``."""
    li = lines(spark, sf_dir)
    rows = assemble(assemble(li, ["price"], "by_price"), ["qty"], "by_qty").select("id", "label", "by_price", "by_qty")
    s = holdout_split(rows, ["id"])
    train, test = s.filter("not is_test").drop("is_test"), s.filter("is_test").drop("is_test")
    models = {"price": OLS(featuresCol="by_price").fit(train), "qty": OLS(featuresCol="by_qty").fit(train)}
    return models, test


_PREDICTED = f"{HOLDOUT}, p AS (SELECT id, label, price * wp + bp AS p0, qty * wq + bq AS p1 FROM te, w)"


@query("mean_blend", f"WITH {_PREDICTED} SELECT id, round((p0 + p1) / 2.0, 2) AS prediction FROM p")
def mean_blend_query(spark, sf_dir):
    models, test = _two_models(spark, sf_dir)
    return predict_all(list(models.values()), test).select("id", F.round(mean_blend(["p0", "p1"]), 2).alias("prediction"))


@query("promote_if_better", f"""
WITH {_PREDICTED}, s AS (SELECT 1 - sum(pow(label - p1, 2)) / (count(*) * var_pop(label)) AS a, 1 - sum(pow(label - (p0 + p1) / 2.0, 2)) / (count(*) * var_pop(label)) AS b FROM p)
SELECT round(a, 8) AS r2_champion, round(b, 8) AS r2_blend, b > a AS promoted FROM s""")
def promote_if_better_query(spark, sf_dir):
    models, test = _two_models(spark, sf_dir)
    scored = predict_all(list(models.values()), test).withColumn("blend", mean_blend(["p0", "p1"]))
    return rounded(promote_if_better(scored, "p1", "blend"), {"r2_champion": 8, "r2_blend": 8})


@query("compare_engines", f"""
WITH {_PREDICTED}, l AS (SELECT 'price' AS model, label, p0 AS prediction FROM p UNION ALL SELECT 'qty', label, p1 FROM p),
s AS (SELECT model, count(*) AS n, {metrics_sql('label', 'prediction')} FROM l GROUP BY model) SELECT model, n, {scores_sql()} FROM s""")
def compare_engines_query(spark, sf_dir):
    models, test = _two_models(spark, sf_dir)
    return rounded(compare_engines(models, test), SCORES)


@query("linear_stack", f"""
WITH {LI}, {exact_folds_sql(5, 1)}, {oof_sql('price', 'a')}, {oof_sql('qty', 'b')},
x AS (SELECT id, a.label, a.prediction AS p0, b.prediction AS p1 FROM a JOIN b USING (id)),
m AS (SELECT avg(p0) AS m0, avg(p1) AS m1, avg(label) AS my FROM x),
c AS (SELECT any_value(m0) AS m0, any_value(m1) AS m1, any_value(my) AS my, sum((p0 - m0) * (p0 - m0)) AS a, sum((p0 - m0) * (p1 - m1)) AS b,
  sum((p1 - m1) * (p1 - m1)) AS d, sum((p0 - m0) * (label - my)) AS e, sum((p1 - m1) * (label - my)) AS f FROM x, m)
SELECT round((e * d - b * f) / (a * d - b * b), 6) AS w0, round((a * f - b * e) / (a * d - b * b), 4) AS w1 FROM c""")
def linear_stack_query(spark, sf_dir):
    """The meta-model sees out-of-fold predictions only."""
    li = lines(spark, sf_dir)
    rows = assemble(assemble(li, ["price"], "by_price"), ["qty"], "by_qty").select("id", "label", "by_price", "by_qty")
    folded = repeated_kfold(rows, ["id"], 5, 1)
    parts = [out_of_fold(OLS(featuresCol=c), folded, ["fold_r0"], keep=["id"]) for c in ("by_price", "by_qty")]
    table = parts[0].select("id", "label", F.col("prediction").alias("p0")).join(
        parts[1].select("id", F.col("prediction").alias("p1")), "id")
    w = linear_stack(table, ["p0", "p1"]).state["coefficients"]
    return spark.createDataFrame([(round(float(w[0]), 6), round(float(w[1]), 4))], "w0 double, w1 double")
