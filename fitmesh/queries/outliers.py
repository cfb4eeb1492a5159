"""Neighbour join and outlier removal."""

from __future__ import annotations

from pyspark.sql import functions as F

from fitmesh.functions.vectors import assemble
from fitmesh.operators.columns import keep_inliers
from fitmesh.operators.knn import knn_join
from fitmesh.operators.lsh import lsh_knn_join
from fitmesh.operators.outliers import IsolationForest, KMeansOutlier, LocalOutlierFactor, drop_small_groups, local_outlier_factor
from fitmesh.queries.registry import lines, query, rounded, table


def neighbours_sql(k: int) -> str:
    return f"""e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
p AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, list_distance(a.v, b.v) AS distance,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id) AS rank FROM e a JOIN e b ON a.vec_id <> b.vec_id
  QUALIFY rank <= {k})"""


LOF_SQL = neighbours_sql(20) + """, kd AS (SELECT query_id, max(distance) AS kd FROM p GROUP BY query_id),
lrd AS (SELECT p.query_id, 1 / (avg(greatest(kd.kd, p.distance)) + 1e-10) AS lrd FROM p JOIN kd ON kd.query_id = p.neighbor_id GROUP BY p.query_id),
lof AS (SELECT p.query_id AS id, avg(n.lrd) / any_value(me.lrd) AS lof FROM p JOIN lrd n ON n.query_id = p.neighbor_id JOIN lrd me ON me.query_id = p.query_id GROUP BY p.query_id)"""


@query("knn_join", f"WITH {neighbours_sql(5)} SELECT query_id, neighbor_id, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM p")
def knn_join_query(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return rounded(knn_join(e, None, 5, query_id="vec_id", vector="embedding"), {"distance": 6})


@query("knn_join_lsh", f"WITH {neighbours_sql(5)} SELECT count(*) AS n_pairs, count(*) AS n_exact_distances, true AS recall_is_high FROM p")
def knn_join_lsh_query(spark, sf_dir):
    """Hashed neighbours against the exact ones: as many, true distances, at least 0.9 of them the same."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    pair = ["query_id", "neighbor_id"]
    hashed = lsh_knn_join(e, None, 5, query_id="vec_id", vector="embedding").drop("rank")
    exact = knn_join(e, None, 5, query_id="vec_id", vector="embedding").select(*pair, F.lit(1).alias("hit"))
    v = e.select("vec_id", "embedding")
    both = hashed.join(exact, pair, "left").join(v.toDF("query_id", "a"), "query_id").join(v.toDF("neighbor_id", "b"), "neighbor_id")
    true = F.sqrt(F.aggregate(F.zip_with("a", "b", lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x))
    return both.agg(F.count(F.lit(1)).alias("n_pairs"), F.count_if(F.abs(F.col("distance") - true) < 1e-9).alias("n_exact_distances"),
                    (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("recall_is_high"))


@query("local_outlier_factor", f"WITH {LOF_SQL} SELECT id, round(lof, 8) AS lof FROM lof")
def local_outlier_factor_query(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return rounded(local_outlier_factor(e, 20, "vec_id", "embedding"), {"lof": 8})


@query("keep_inliers", f"WITH {LOF_SQL}, c AS (SELECT quantile_cont(lof, 0.9) AS c FROM lof) SELECT vec_id, label FROM embeddings JOIN lof ON id = vec_id, c WHERE lof <= c")
def keep_inliers_query(spark, sf_dir):
    """The label leaves with its row."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    masked = LocalOutlierFactor(idCol="vec_id", featuresCol="embedding", contamination=0.1).mask(e)
    return keep_inliers(masked).select("vec_id", "label")


@query("isolation_forest", """
WITH n AS (SELECT count(*) AS n FROM lineitem), k AS (SELECT n, CAST(floor(0.95 * (n - 1)) AS BIGINT) + 1 AS kept FROM n)
SELECT true AS is_inlier, kept AS n FROM k UNION ALL SELECT false, n - kept FROM k""")
def isolation_forest(spark, sf_dir):
    """The contamination percentile fixes how many rows are kept."""
    v = assemble(lines(spark, sf_dir), ["qty", "price", "disc", "tax"]).select("id", "features")
    masked = IsolationForest(contamination=0.05).mask(v)
    return masked.groupBy("is_inlier").agg(F.count(F.lit(1)).alias("n"))


@query("isolation_forest_scores")
def isolation_forest_scores(spark, sf_dir):
    v = assemble(lines(spark, sf_dir), ["qty", "price", "disc", "tax"]).select("id", "features")
    return IsolationForest(n_estimators=25).mask(v).select("id", "score", "is_inlier")


@query("kmeans_outliers", """
WITH li AS (SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS id, l_discount FROM lineitem)
SELECT id FROM li WHERE l_discount > 0""")
def kmeans_outliers(spark, sf_dir):
    """Rows without a discount lie far from the rest and make up less than a fifth."""
    li = lines(spark, sf_dir).withColumn("far", F.when(F.col("disc") > 0, F.col("disc")).otherwise(1000.0))
    v = assemble(li, ["far"]).select("id", "features")
    return KMeansOutlier(n_clusters=2, min_cluster_size_ratio=0.2, n_init=3).clean(v).select("id")


@query("kmeans_clusters")
def kmeans_clusters(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    masked = KMeansOutlier(featuresCol="embedding", n_clusters=8, min_cluster_size_ratio=0.1, n_init=3).mask(e)
    return masked.groupBy("cluster", "is_inlier").agg(F.count(F.lit(1)).alias("n"))


@query("drop_small_groups", """
WITH d AS (SELECT doc_id, lang || ':' || source AS grp, n_chars FROM documents),
k AS (SELECT grp FROM d GROUP BY grp HAVING count(*) >= 0.02 * (SELECT count(*) FROM documents))
SELECT doc_id, grp, n_chars FROM d WHERE grp IN (SELECT grp FROM k)""")
def drop_small_groups_query(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(":", "lang", "source").alias("grp"), "n_chars")
    return drop_small_groups(d, "grp", 0.02)
