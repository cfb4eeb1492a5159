import math

import pytest
from pyspark.sql import functions as F

from fitmesh.operators import splits
from fitmesh.operators.rank import ordered_rank, row_positions
from fitmesh.operators.splits import fold_ranks, folds_long, holdout_split, kfold, repeated_kfold


@pytest.mark.parametrize("n,size", [(400, 0.2), (7, 0.2), (1, 0.2), (1001, 0.25)])
def test_holdout_size_is_exact(spark, n, size):
    out = holdout_split(spark.range(n), ["id"], size)
    assert out.filter("is_test").count() == math.ceil(round(size * n, 9))
    assert out.count() == n


def test_folds_are_disjoint_covering_balanced_and_repeat_independent(spark):
    out = repeated_kfold(spark.range(1003), ["id"], 5, 3)
    for c in ("fold_r0", "fold_r1", "fold_r2"):
        counts = {r[c]: r["count"] for r in out.groupBy(c).count().collect()}
        assert counts == {0: 201, 1: 201, 2: 201, 3: 200, 4: 200}
    assert out.filter("fold_r0 = fold_r1").count() < 400
    assert folds_long(out, ["fold_r0", "fold_r1", "fold_r2"]).count() == 3009


def test_assignment_does_not_depend_on_partitioning(spark):
    a = kfold(spark.range(500).repartition(1), ["id"], 4).orderBy("id").collect()
    b = kfold(spark.range(500).repartition(7), ["id"], 4).orderBy("id").collect()
    assert a == b
    assert a != kfold(spark.range(500), ["id"], 4, seed=1).orderBy("id").collect()


def test_cuts_refine_through_several_histogram_passes(spark, monkeypatch):
    whole = kfold(spark.range(3000), ["id"], 7).orderBy("id").collect()
    monkeypatch.setattr(splits, "_COLLECT_LIMIT", 0)
    assert kfold(spark.range(3000), ["id"], 7).orderBy("id").collect() == whole


def test_the_driver_gets_one_hash_a_cut(spark, monkeypatch):
    df = spark.range(6000).select((F.col("id") % 3).alias("k"))  # cells of 2000 rows
    kind, got = type(df), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: got.append(collect(self)) or got[-1])
    out = kfold(df, ["k"], 5)
    assert sum(map(len, got)) <= 3 + 4
    monkeypatch.undo()
    counts = {r["fold"]: r["count"] for r in out.groupBy("fold").count().collect()}
    assert sum(counts.values()) == 6000 and all(v % 2000 == 0 for v in counts.values())


def test_rows_with_one_key_stay_together(spark):
    df = spark.range(1000).select((F.col("id") % 50).alias("k"))
    assert kfold(df, ["k"], 5).groupBy("k").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0


def test_empty_input(spark):
    assert holdout_split(spark.range(0), ["id"]).count() == 0
    assert kfold(spark.range(0), ["id"], 5).count() == 0
    assert ordered_rank(spark.range(0), ["id"]).count() == 0


def test_fold_ranks():
    assert fold_ranks(11, 4) == [3, 6, 9]


def test_bad_mode(spark):
    with pytest.raises(ValueError):
        holdout_split(spark.range(5), ["id"], mode="maybe")


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_rank_breaks_ties_by_key(spark, partitions):
    df = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).alias("v"))
    got = {r["id"]: r["rank"] for r in ordered_rank(df, ["v", "id"], partitions=partitions).collect()}
    rows = sorted((r["v"], r["id"]) for r in df.collect())
    assert got == {i: n for n, (_, i) in enumerate(rows)}


def test_positions_follow_file_order(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 4).write.parquet(path)
    got = row_positions(spark.read.parquet(path)).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1000))
    assert [r["id"] for r in got] == list(range(1000))
