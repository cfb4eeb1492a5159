"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from fitmesh.session import build_session

HEADLINE = [
    "ols_repeated_cv", "scaled_chain_cv", "random_search_ridge", "feature_engineering", "target_encoding", "robust_scaling",
    "quantile_transform", "repeated_kfold", "grouped_prediction", "linear_stack", "knn_join", "local_outlier_factor",
    "isolation_forest", "forest_cv", "gradient_boosting", "extra_trees",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("fitmesh-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    from fitmesh.queries import QUERIES

    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the JVM's scan path
    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
