"""Sources, columns, encoders, scalers, components, splits and shared kernels."""

from __future__ import annotations

from pyspark.sql import functions as F

from fitmesh.functions.vectors import assemble
from fitmesh.operators.columns import (align_xy, attach_components, dataset_profile, first_column_target, interactions,
                                       split_target, type_table)
from fitmesh.operators.encode import TargetEncode
from fitmesh.operators.rank import ordered_rank
from fitmesh.operators.reduce import PCA
from fitmesh.operators.scale import QuantileTransform, RobustScale, StandardScale
from fitmesh.operators.splits import folds_long, holdout_split, kfold, repeated_kfold
from fitmesh.operators.stats import sufficient_stats
from fitmesh.plans.features import FeaturePipeline
from fitmesh.queries.registry import LI, hash_sql, lines, query, rounded, table
from fitmesh.sources.records import scratch_path
from fitmesh.sources.tables import dataset_sweep, load_pair, load_table

# --------------------------------------------------------------------------- sources


@query("load_csv_table", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, count(o_custkey) AS with_customer
FROM orders GROUP BY o_orderstatus""")
def load_csv_table(spark, sf_dir):
    path = scratch_path(spark, "orders") + ".csv"
    table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice").write.csv(path, header=True)
    x = load_table(spark, path)
    return x.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
                                          F.count("o_custkey").alias("with_customer"))


@query("load_csv_pair", """
SELECT count(*) AS n, round(sum(l_quantity), 2) AS sum_x, round(sum(l_extendedprice), 2) AS sum_y,
  round(sum(l_quantity * l_extendedprice) / 1e6, 4) AS sum_xy FROM lineitem""")
def load_csv_pair(spark, sf_dir):
    li = lines(spark, sf_dir)
    x_path, y_path = scratch_path(spark, "predictors") + ".csv", scratch_path(spark, "target") + ".csv"
    li.select("id", "qty").write.csv(x_path, header=True)
    li.select("id", "price").write.csv(y_path, header=True)
    pair = load_pair(spark, x_path, y_path, key=["id"])
    return pair.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("qty"), 2).alias("sum_x"), F.round(F.sum("label"), 2).alias("sum_y"),
                    F.round(F.sum(F.col("qty") * F.col("label")) / 1e6, 4).alias("sum_xy"))


@query("load_csv_integer_key", """
SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n, round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY l_orderkey""")
def load_csv_integer_key(spark, sf_dir):
    path = scratch_path(spark, "lines") + ".csv"
    table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice").write.csv(path, header=True)
    x = load_table(spark, path)
    return x.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("parquet_scan", """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, round(avg(l_extendedprice), 4) AS price
FROM lineitem WHERE l_quantity > 10 GROUP BY l_returnflag, l_linestatus""")
def parquet_scan(spark, sf_dir):
    return (table(spark, sf_dir, "lineitem").filter("l_quantity > 10").groupBy("l_returnflag", "l_linestatus")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"), F.round(F.avg("l_extendedprice"), 4).alias("price")))


@query("align_by_key", "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice AS label FROM orders")
def align_by_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return align_xy(o.select("o_orderkey", "o_custkey", "o_orderpriority"),
                    o.select("o_orderkey", F.col("o_totalprice").alias("label")), ["o_orderkey"])


@query("align_by_position", "SELECT o_orderkey, o_orderpriority, o_totalprice AS label FROM orders")
def align_by_position(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return align_xy(o.select("o_orderkey", "o_orderpriority"), o.select(F.col("o_totalprice").alias("label")))


@query("split_target", "SELECT p_partkey, p_size, p_brand, p_retailprice AS label FROM part")
def split_target_query(spark, sf_dir):
    return split_target(table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand", "p_retailprice"), "p_retailprice")


@query("first_column_target", "SELECT event_id, \"value\" AS label FROM events")
def first_column_target_query(spark, sf_dir):
    return first_column_target(table(spark, sf_dir, "events").select("event_id", "value", "user_id"), keep=["event_id"])


def _profile_sql(columns):
    parts = []
    for name, kind, floating in columns:
        nan = f"count(*) FILTER (WHERE isnan({name}))" if floating else "0"
        low, high = (f"CAST(min({name}) AS DOUBLE)", f"CAST(max({name}) AS DOUBLE)") if kind == "numeric" else (
            "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)")
        parts.append(f"SELECT count(*) AS n_rows, {len(columns) - 1} AS n_features, 'l_extendedprice' AS target, '{name}' AS \"column\", "
                     f"'{kind}' AS kind, count(*) - count({name}) AS n_null, {nan} AS n_nan, count(DISTINCT {name}) AS n_distinct, {low} AS \"min\", {high} AS \"max\" FROM lineitem")
    return " UNION ALL ".join(parts)


_LINEITEM = [("l_orderkey", "numeric", False), ("l_partkey", "numeric", False), ("l_suppkey", "numeric", False),
             ("l_linenumber", "numeric", False), ("l_quantity", "numeric", True), ("l_extendedprice", "numeric", True),
             ("l_discount", "numeric", True), ("l_tax", "numeric", True), ("l_returnflag", "categorical", False),
             ("l_linestatus", "categorical", False), ("l_shipdate", "passthrough", False)]


@query("dataset_profile", _profile_sql(_LINEITEM))
def dataset_profile_query(spark, sf_dir):
    return dataset_profile(table(spark, sf_dir, "lineitem"), "l_extendedprice")


@query("column_kinds", "SELECT position, column_name AS \"column\", kind, n_present FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS position, '{n}' AS column_name, '{k}' AS kind, count({n}) AS n_present FROM lineitem"
    for i, (n, k, _) in enumerate(_LINEITEM)) + ")")
def column_kinds(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    counts = li.agg(*[F.count(c).alias(c) for c in li.columns]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("n_present")) for c in li.columns])))
    return type_table(li).join(counts, "column").select("position", "column", "kind", "n_present")


@query("dataset_sweep", """
SELECT 'lineitem' AS dataset, 'ok' AS status, CAST(count(*) AS DOUBLE) AS n, round(regr_r2(l_extendedprice, l_quantity), 8) AS r2,
  round(regr_slope(l_extendedprice, l_quantity), 5) AS slope FROM lineitem
UNION ALL SELECT 'orders', 'ok', count(*), round(regr_r2(o_totalprice, o_custkey), 8), round(regr_slope(o_totalprice, o_custkey), 5) FROM orders
UNION ALL SELECT 'part', 'ok', count(*), round(regr_r2(p_retailprice, p_size), 8), round(regr_slope(p_retailprice, p_size), 5) FROM part
UNION ALL SELECT 'broken', 'failed', NULL, NULL, NULL""")
def dataset_sweep_query(spark, sf_dir):
    def job(name, x, y):
        df = table(spark, sf_dir, name).select(F.col(x).cast("double").alias("x"), F.col(y).alias("y"))
        return lambda: df.agg(F.count(F.lit(1)).cast("double").alias("n"), F.round(F.regr_r2("y", "x"), 8).alias("r2"),
                              F.round(F.regr_slope("y", "x"), 5).alias("slope"))

    def broken():
        return load_table(spark, f"{sf_dir}/no_such_table.parquet")

    return dataset_sweep(spark, {"lineitem": job("lineitem", "l_quantity", "l_extendedprice"),
                                 "orders": job("orders", "o_custkey", "o_totalprice"),
                                 "part": job("part", "p_size", "p_retailprice"), "broken": broken}, 4).drop("error")


# --------------------------------------------------------------------------- columns


@query("interaction_terms", f"""
WITH {LI} SELECT id, qty * price AS qty_x_price, qty * disc AS qty_x_disc, price * disc AS price_x_disc FROM li""")
def interaction_terms(spark, sf_dir):
    li = lines(spark, sf_dir).select("id", "qty", "price", "disc", "tax")
    return interactions(li, 3).select("id", "qty_x_price", "qty_x_disc", "price_x_disc")


@query("assemble_features", f"WITH {LI} SELECT id, price AS f1, disc AS f2, tax AS f3, 3 AS width FROM li")
def assemble_features(spark, sf_dir):
    v = assemble(lines(spark, sf_dir), ["price", "disc", "tax"])
    return v.select("id", F.col("features")[0].alias("f1"), F.col("features")[1].alias("f2"), F.col("features")[2].alias("f3"),
                    F.size("features").alias("width"))


# --------------------------------------------------------------------------- encoders and scalers


@query("target_encoding", """
WITH o AS (SELECT *, CAST(o_custkey AS VARCHAR) AS cust FROM orders), g AS (SELECT avg(o_totalprice) AS m FROM o)
SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_orderpriority), 4) AS o_orderpriority,
  round(avg(o_totalprice) OVER (PARTITION BY cust), 6) AS cust FROM o""")
def target_encoding(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.col("o_custkey").cast("string").alias("cust"),
                                              F.col("o_totalprice").alias("label"))
    model = TargetEncode(columns=["o_orderpriority", "cust"]).fit(o)
    return rounded(model.transform(o).drop("label"), {"o_orderpriority": 4, "cust": 6})


_CUST_SPLIT = f"""o AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS cust, o_totalprice AS y,
  row_number() OVER (ORDER BY {hash_sql(42, key='o_orderkey')}) - 1 AS r, count(*) OVER () AS n FROM orders),
s AS (SELECT *, r < ceil(0.2 * n) AS is_test FROM o)"""


@query("target_encoding_unseen", f"""
WITH {_CUST_SPLIT}, m AS (SELECT cust, avg(y) AS mean FROM s WHERE NOT is_test GROUP BY cust), g AS (SELECT avg(y) AS mean FROM s WHERE NOT is_test)
SELECT count(*) AS n, count(*) FILTER (WHERE m.mean IS NULL) AS n_unseen, round(sum(coalesce(m.mean, g.mean)) / 1e3, 4) AS total
FROM s LEFT JOIN m USING (cust) CROSS JOIN g WHERE is_test""")
def target_encoding_unseen(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("cust"),
                                              F.col("o_totalprice").alias("label"))
    s = holdout_split(o, ["o_orderkey"])
    model = TargetEncode(columns=["cust"]).fit(s.filter("not is_test"))
    enc = model.transform(s.filter("is_test"))
    return enc.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("cust") == F.lit(model.global_mean)).alias("n_unseen"),
                   F.round(F.sum("cust") / 1e3, 4).alias("total"))


@query("standard_scaling", f"""
WITH {LI}, s AS (SELECT avg(qty) AS mq, stddev_pop(qty) AS sq, avg(price) AS mp, stddev_pop(price) AS sp FROM li)
SELECT id, round((qty - mq) / sq, 5) + 0.0 AS qty, round((price - mp) / sp, 5) + 0.0 AS price FROM li, s""")
def standard_scaling(spark, sf_dir):
    v = assemble(lines(spark, sf_dir), ["qty", "price"])
    out = StandardScale().fit(v).transform(v)
    return out.select("id", F.round(F.col("features")[0], 5).alias("qty"), F.round(F.col("features")[1], 5).alias("price"))


@query("robust_scaling", """
WITH s AS (SELECT quantile_cont("value", 0.5) AS m, quantile_cont("value", 0.75) - quantile_cont("value", 0.25) AS r,
  quantile_cont(user_id, 0.5) AS mu, quantile_cont(user_id, 0.75) - quantile_cont(user_id, 0.25) AS ru FROM events)
SELECT event_id, round(("value" - m) / r, 5) + 0.0 AS "value", round((user_id - mu) / ru, 5) + 0.0 AS user_id FROM events, s""")
def robust_scaling(spark, sf_dir):
    v = assemble(table(spark, sf_dir, "events").select("event_id", "value", "user_id"), ["value", "user_id"])
    out = RobustScale().fit(v).transform(v)
    return out.select("event_id", F.round(F.col("features")[0], 5).alias("value"), F.round(F.col("features")[1], 5).alias("user_id"))


_GRID = ", ".join(f"{i / 10}" for i in range(11))


@query("quantile_transform", f"""
WITH {LI}, g AS (SELECT quantile_cont(price, [{_GRID}]) AS q FROM li),
c AS (SELECT id, price, q, greatest(1, least(10, len(list_filter(q, lambda v: v <= price)))) AS i FROM li, g)
SELECT id, round(CASE WHEN price <= q[1] THEN 0.0 WHEN price >= q[11] THEN 1.0
  ELSE (i - 1) / 10.0 + 0.1 * (price - q[i]) / (q[i + 1] - q[i]) END, 5) AS price FROM c""")
def quantile_transform(spark, sf_dir):
    v = assemble(lines(spark, sf_dir), ["price"])
    out = QuantileTransform(n_quantiles=11).fit(v).transform(v)
    return out.select("id", F.round(F.col("features")[0], 5).alias("price"))


def _polynomial(coefficients: list[float], x: str) -> str:
    out = str(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c})"
    return out


# fixed values: rational approximation of the inverse normal CDF, relative error below 1.2e-9
_PPF_A = [-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239]
_PPF_B = [-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0]
_PPF_C = [-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783]
_PPF_D = [0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0]


@query("quantile_transform_normal", f"""
WITH {LI}, g AS (SELECT quantile_cont(price, [{", ".join(f"{i}/999::DOUBLE" for i in range(1000))}]) AS q FROM li),
c AS (SELECT l_returnflag, price, q, greatest(1, least(999, len(list_filter(q, lambda v: v <= price)))) AS i FROM li, g),
u AS (SELECT l_returnflag, greatest(1e-7::DOUBLE, least(1 - 1e-7::DOUBLE, CASE WHEN price <= q[1] THEN 0.0 WHEN price >= q[1000] THEN 1.0
  ELSE (i - 1) / 999.0::DOUBLE + (price - q[i]) / (q[i + 1] - q[i]) / 999.0::DOUBLE END)) AS p FROM c),
t AS (SELECT *, least(p, 1 - p) AS h, sqrt(-2 * ln(least(p, 1 - p))) AS r, p - 0.5 AS m FROM u),
z AS (SELECT l_returnflag, CASE WHEN h < 0.02425 THEN sign(0.5 - p) * {_polynomial(_PPF_C, "r")} / {_polynomial(_PPF_D, "r")}
  ELSE m * {_polynomial(_PPF_A, "(m * m)")} / {_polynomial(_PPF_B, "(m * m)")} END AS z FROM t)
SELECT l_returnflag, count(*) AS n, round(avg(z), 6) AS mean, round(stddev_pop(z), 6) AS deviation, round(min(z), 6) AS least, round(max(z), 6) AS most
FROM z GROUP BY l_returnflag""")
def quantile_transform_normal(spark, sf_dir):
    """The default grid of 1000 points and the normal scale, summed up by flag."""
    v = assemble(lines(spark, sf_dir, "l_returnflag"), ["price"])
    z = F.col("features")[0]
    out = QuantileTransform(output="normal").fit(v).transform(v)
    return out.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), *[F.round(f(z), 6).alias(c) for f, c in (
        (F.avg, "mean"), (F.stddev_pop, "deviation"), (F.min, "least"), (F.max, "most"))])


_AXES = f"""{LI}, v AS (SELECT id, price / 1e3 AS a, label / 1e3 AS b FROM li),
m AS (SELECT avg(a) AS ma, avg(b) AS mb, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab FROM v),
e AS (SELECT *, (aa + bb) / 2 + sqrt(pow((aa - bb) / 2, 2) + ab * ab) AS l1, (aa + bb) / 2 - sqrt(pow((aa - bb) / 2, 2) + ab * ab) AS l2 FROM m),
u AS (SELECT *, ab / sqrt(ab * ab + pow(l1 - aa, 2)) AS ux, (l1 - aa) / sqrt(ab * ab + pow(l1 - aa, 2)) AS uy FROM e),
w AS (SELECT *, CASE WHEN (CASE WHEN abs(ux) >= abs(uy) THEN ux ELSE uy END) < 0 THEN -1 ELSE 1 END AS s1,
  CASE WHEN (CASE WHEN abs(uy) >= abs(ux) THEN -uy ELSE ux END) < 0 THEN -1 ELSE 1 END AS s2 FROM u)"""


def _two_columns(spark, sf_dir):
    li = lines(spark, sf_dir).select("id", (F.col("price") / 1e3).alias("a"), (F.col("label") / 1e3).alias("b"))
    return assemble(li, ["a", "b"])


@query("component_columns", f"""
WITH {_AXES} SELECT id, round(s1 * ((a - ma) * ux + (b - mb) * uy), 4) + 0.0 AS pc1,
  round(s2 * ((a - ma) * -uy + (b - mb) * ux), 4) + 0.0 AS pc2 FROM v, w""")
def component_columns(spark, sf_dir):
    v = _two_columns(spark, sf_dir)
    out = attach_components(PCA(n_components=2).fit(v).transform(v), "features", 2, keep=["id"])
    return rounded(out, {"pc1": 4, "pc2": 4})


@query("pca_variance", f"""
WITH {_AXES} SELECT count(*) AS n, 1 AS n_components, round(var_pop(s1 * ((a - ma) * ux + (b - mb) * uy)), 4) AS kept_variance FROM v, w""")
def pca_variance(spark, sf_dir):
    v = _two_columns(spark, sf_dir)
    out = PCA(variance=0.95).fit(v).transform(v)
    return out.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("n_components"),
                   F.round(F.var_pop(F.col("features")[0]), 4).alias("kept_variance"))


@query("explained_variance", f"""
WITH {_AXES} SELECT 1 AS component, round(l1 / (l1 + l2), 8) AS ratio, round(l1 / (l1 + l2), 8) AS cumulative FROM w
UNION ALL SELECT 2, round(l2 / (l1 + l2), 8), 1.0 FROM w""")
def explained_variance(spark, sf_dir):
    v = _two_columns(spark, sf_dir)
    ratio = PCA(n_components=2).fit(v).explained_variance_ratio(spark)
    return rounded(ratio, {"ratio": 8, "cumulative": 8})


@query("embedding_components", """
WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS j FROM embeddings),
m AS (SELECT j, avg(v) AS m FROM x GROUP BY j)
SELECT vec_id, round(sum(pow(v - m, 2)), 5) AS squared_norm FROM x JOIN m USING (j) GROUP BY vec_id""")
def embedding_components(spark, sf_dir):
    """All 64 components are kept, so the projection preserves every centred row's length."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out = PCA(inputCol="embedding", outputCol="pc", n_components=64).fit(e).transform(e)
    return out.select("vec_id", F.round(F.aggregate("pc", F.lit(0.0), lambda a, v: a + v * v), 5).alias("squared_norm"))


@query("feature_engineering", f"""
WITH {LI}, f AS (SELECT id, avg(label) OVER (PARTITION BY l_returnflag) AS flag, qty, price, disc, tax FROM li),
z AS (SELECT id, [flag, qty, price, disc, tax, flag * qty, flag * price, qty * price] AS v FROM f),
x AS (SELECT id, unnest(v) AS v, generate_subscripts(v, 1) AS j FROM z),
s AS (SELECT j, avg(v) AS m, stddev_pop(v) AS s FROM x GROUP BY j)
SELECT id, round(sum(pow((v - m) / s, 2)), 3) AS squared_norm FROM x JOIN s USING (j) GROUP BY id""")
def feature_engineering(spark, sf_dir):
    """Encode, interact, scale, project. With every component kept the squared norm survives the rotation."""
    li = lines(spark, sf_dir, "l_returnflag").select("id", "l_returnflag", "qty", "price", "disc", "tax", "label")
    model = FeaturePipeline(columns=["l_returnflag", "qty", "price", "disc", "tax"], variance=1.0 - 1e-15).fit(li)
    return model.transform(li).select("id", F.round(F.aggregate("features", F.lit(0.0), lambda a, v: a + v * v), 3).alias("squared_norm"))


# --------------------------------------------------------------------------- splits


@query("holdout_split", f"""
WITH {LI}, r AS (SELECT id, row_number() OVER (ORDER BY {hash_sql(42)}) - 1 AS r, count(*) OVER () AS n FROM li)
SELECT id, r < ceil(0.2 * n) AS is_test FROM r""")
def holdout_split_query(spark, sf_dir):
    return holdout_split(lines(spark, sf_dir).select("id"), ["id"])


@query("inner_validation_split", f"""
WITH {LI}, r AS (SELECT id, row_number() OVER (ORDER BY {hash_sql(42)}) - 1 AS r, count(*) OVER () AS n FROM li),
t AS (SELECT id FROM r WHERE NOT r < ceil(0.2 * n)),
q AS (SELECT id, row_number() OVER (ORDER BY {hash_sql(7)}) - 1 AS r, count(*) OVER () AS n FROM t)
SELECT id, r < ceil(0.25 * n) AS is_valid FROM q""")
def inner_validation_split(spark, sf_dir):
    train = holdout_split(lines(spark, sf_dir).select("id"), ["id"]).filter("not is_test").select("id")
    return holdout_split(train, ["id"], 0.25, seed=7, out="is_valid")


@query("kfold_assignment", f"""
WITH {LI}, r AS (SELECT id, row_number() OVER (ORDER BY {hash_sql(42)}) - 1 AS r, count(*) OVER () AS n FROM li)
SELECT id, CAST(CASE WHEN r < (n % 7) * (n // 7 + 1) THEN r // (n // 7 + 1) ELSE n % 7 + (r - (n % 7) * (n // 7 + 1)) // (n // 7) END AS INTEGER) AS fold FROM r""")
def kfold_assignment(spark, sf_dir):
    return kfold(lines(spark, sf_dir).select("id"), ["id"], 7)


def exact_folds_sql(k: int, repeats: int, source: str = "li") -> str:
    parts = [f"SELECT id, {r} AS repeat, row_number() OVER (ORDER BY {hash_sql(42, r)}) - 1 AS r, count(*) OVER () AS n FROM {source}"
             for r in range(repeats)]
    return (f"ranked AS ({' UNION ALL '.join(parts)}), folds AS (SELECT id, repeat, CAST(CASE WHEN r < (n % {k}) * (n // {k} + 1) "
            f"THEN r // (n // {k} + 1) ELSE n % {k} + (r - (n % {k}) * (n // {k} + 1)) // (n // {k}) END AS INTEGER) AS fold FROM ranked)")


@query("repeated_kfold", f"WITH {LI}, {exact_folds_sql(5, 3)} SELECT id, repeat, fold FROM folds")
def repeated_kfold_query(spark, sf_dir):
    return folds_long(repeated_kfold(lines(spark, sf_dir).select("id"), ["id"], 5, 3), ["fold_r0", "fold_r1", "fold_r2"])


# --------------------------------------------------------------------------- kernels


@query("ordered_rank", """SELECT event_id, row_number() OVER (ORDER BY "value", event_id) - 1 AS rank FROM events""")
def ordered_rank_query(spark, sf_dir):
    return ordered_rank(table(spark, sf_dir, "events").select("event_id", "value"), ["value", "event_id"]).select("event_id", "rank")


@query("sufficient_stats", """
SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS sx1, round(sum(l_discount), 2) AS sx2, round(sum(l_extendedprice), 2) AS sy,
  round(sum(l_quantity * l_quantity), 2) AS xx11, round(sum(l_quantity * l_discount), 2) AS xx12, round(sum(l_discount * l_discount), 4) AS xx22,
  round(sum(l_quantity * l_extendedprice) / 1e3, 2) AS xy1, round(sum(l_discount * l_extendedprice), 2) AS xy2,
  round(sum(l_extendedprice * l_extendedprice) / 1e6, 2) AS yy FROM lineitem GROUP BY l_returnflag""")
def sufficient_stats_query(spark, sf_dir):
    s = sufficient_stats(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice", ["l_returnflag"])
    c = F.col
    return s.select("l_returnflag", "n", F.round(c("sum_x")[0], 2).alias("sx1"), F.round(c("sum_x")[1], 2).alias("sx2"),
                    F.round("sum_y", 2).alias("sy"), F.round(c("xtx")[0], 2).alias("xx11"), F.round(c("xtx")[1], 2).alias("xx12"),
                    F.round(c("xtx")[2], 4).alias("xx22"), F.round(c("xty")[0] / 1e3, 2).alias("xy1"), F.round(c("xty")[1], 2).alias("xy2"),
                    F.round(c("yty") / 1e6, 2).alias("yy"))
