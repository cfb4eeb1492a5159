import numpy as np
import pytest
from frames import vectors
from pyspark.sql import functions as F

from fitmesh.functions.vectors import matrix
from fitmesh.operators import lookup, orderstats, partials, reduce
from fitmesh.operators.encode import TargetEncode, TargetEncodeModel
from fitmesh.operators.orderstats import order_statistics, quantiles
from fitmesh.operators.reduce import PCA, PCAModel
from fitmesh.operators.scale import LinearMapModel, QuantileTransform, RobustScale, StandardScale
from fitmesh.operators.splits import holdout_split
from fitmesh.plans.features import FeaturePipeline, FeaturePipelineModel


def values(df, column="features"):
    return np.array([r[column] for r in df.orderBy("id").collect()])


def test_encoder_missing_unseen_and_meanless_categories(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 8.0), (None, 4.0), ("c", float("nan"))], "c string, label double")
    model = TargetEncode(columns=["c"]).fit(train)
    new = spark.createDataFrame([("a",), ("b",), (None,), ("zz",), ("c",)], "c string")
    assert [r["c"] for r in model.transform(new).collect()] == [2.0, 8.0, 4.0, 4.0, 4.0]


def test_encoder_save_and_load(spark, tmp_path):
    train = spark.createDataFrame([("a", 1.0), ("b", 8.0)], "c string, label double")
    model = TargetEncode(columns=["c"]).fit(train)
    model.save(str(tmp_path / "m"))
    again = TargetEncodeModel.load(str(tmp_path / "m"))
    assert again.transform(train).collect() == model.transform(train).collect()


def test_large_lookup_keeps_every_row_of_a_hot_key(spark, monkeypatch):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))).alias("c"), (F.col("id") % 17).cast("double").alias("label"))
    df = df.unionAll(spark.createDataFrame([(9999, None, 1.0)], "id long, c string, label double"))
    model = TargetEncode(columns=["c"]).fit(df)
    small = model.transform(df).orderBy("id").collect()
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(lookup, "HOT_SHARE", 0.05)
    assert model.transform(df).orderBy("id").collect() == small


@pytest.mark.parametrize("rows_per_bucket", [250_000, 3])
def test_order_statistics_match_sorting(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(orderstats, "_CELL_ROWS", rows_per_bucket)
    rng = np.random.default_rng(3)
    a = np.where(rng.random(900) < 0.4, 5.0, rng.normal(size=900))  # one value holds 40% of the rows
    b = rng.integers(0, 4, 900).astype(float)
    rows = [(float(x), float(y)) for x, y in zip(a, b)] + [(None, float("nan"))] * 5
    df = spark.createDataFrame(rows, "a double, b double").repartition(5)
    totals, found = order_statistics(df, ["a", "b"], lambda c, n: range(n))
    assert totals == {"a": 900, "b": 900}
    assert [found["a"][i] for i in range(900)] == sorted(a)
    assert [found["b"][i] for i in range(900)] == sorted(b)
    q = quantiles(df, ["a", "b"], [0.0, 0.1, 0.5, 0.99, 1.0])
    assert np.allclose(q["a"], np.quantile(a, [0.0, 0.1, 0.5, 0.99, 1.0]))


def test_last_shuffle_carries_a_small_part_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(orderstats, "_SENT", 10)
    a = np.random.default_rng(6).normal(size=2000)
    df = spark.createDataFrame([(float(v), float(v > 0)) for v in a], "a double, b double").repartition(3)
    counted, children = [], orderstats._children

    def count(data, names, cells, *rest):
        counted.append([len(c) for c in cells.values()])
        return children(data, names, cells, *rest)

    monkeypatch.setattr(orderstats, "_children", count)
    totals, found = order_statistics(df, ["a", "b"], lambda c, n: range(0, n, 10))
    assert len(counted) >= 2 and counted[1][0] > 10  # cells far below _CELL_ROWS each
    assert found == {"a": dict(zip(range(0, 2000, 10), np.sort(a)[::10])), "b": dict(zip(range(0, 2000, 10), np.sort(a > 0)[::10].astype(float)))}
    monkeypatch.setattr(orderstats, "_COUNTERS", 0)  # too many parts to count: they are sent
    counted.clear()
    assert order_statistics(df, ["a", "b"], lambda c, n: range(0, n, 10)) == (totals, found) and len(counted) == 1


def test_order_statistics_of_signs_zeros_infinities_and_one_hot_value(spark, monkeypatch):
    monkeypatch.setattr(orderstats, "_CELL_ROWS", 20)
    inf = float("inf")
    a = [-inf, -1e300, -1.5, -1e-300, -0.0, 0.0, 5e-324, 1e-300, 1.5, 1.5 + 2**-52, 1e300, inf] + [7.25] * 400
    df = spark.createDataFrame([(x, None) for x in a], "a double, b double").repartition(30)
    totals, found = order_statistics(df, ["a", "b"], lambda c, n: range(n))
    assert totals == {"a": len(a), "b": 0} and [found["a"][i] for i in range(len(a))] == sorted(a) and found["b"] == {}


def test_scalers_on_known_values(spark):
    df = vectors(spark, [[1.0], [2.0], [4.0], [9.0]])
    std = StandardScale().fit(df)
    assert np.allclose(values(std.transform(df))[:, 0], (np.array([1, 2, 4, 9]) - 4) / 3.0822070)
    rob = RobustScale().fit(df)
    assert rob.state["centre"][0] == 3.0 and rob.state["scale"][0] == 5.25 - 1.75


def test_constant_column_and_one_row(spark):
    df = vectors(spark, [[5.0, 0.1]] * 3)
    assert np.allclose(values(StandardScale().fit(df).transform(df)), 0, atol=1e-12)
    assert np.all(values(RobustScale().fit(df).transform(df)) == 0)
    assert np.all(values(QuantileTransform().fit(df).transform(df)) == 0)
    one = vectors(spark, [[5.0]])
    assert values(StandardScale().fit(one).transform(one))[0, 0] == 0


def test_wide_scaling_matches_numpy(spark):
    x = np.random.default_rng(1).normal(5, 2, (60, 90))
    out = StandardScale().fit(df := vectors(spark, x)).transform(df)
    assert np.allclose(values(out), (x - x.mean(0)) / x.std(0))


def test_quantile_transform_ties_and_clipping(spark):
    x = np.array([1, 1, 1, 2, 3, 4, 4, 9], float)
    df = vectors(spark, x[:, None])
    model = QuantileTransform(n_quantiles=8).fit(df)
    grid, refs = np.quantile(x, np.linspace(0, 1, 8)), np.linspace(0, 1, 8)
    expect = 0.5 * (np.interp(x, grid, refs) - np.interp(-x, -grid[::-1], -refs[::-1]))
    expect[x == 1] = 0.0
    assert np.allclose(values(model.transform(df))[:, 0], expect)
    beyond = vectors(spark, [[-100.0], [100.0]])
    assert list(values(model.transform(beyond))[:, 0]) == [0.0, 1.0]
    normal = QuantileTransform(n_quantiles=8, output="normal").fit(df).transform(df)
    assert abs(values(normal)[:, 0].min() + 5.1993375) < 1e-5


@pytest.mark.parametrize("shape", [(200, 4), (200, 30), (40, 600)])
def test_pca_matches_svd(spark, shape):
    rng = np.random.default_rng(0)
    x = rng.normal(size=shape) @ np.diag(np.linspace(3, 0.1, shape[1])) + 100
    df = vectors(spark, x)
    model = PCA(n_components=3).fit(df)
    u, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    w = np.atleast_2d(model.state["components"])
    assert np.allclose(np.abs(w), np.abs(vt[:3]), atol=1e-6)
    assert np.allclose(w @ w.T, np.eye(3), atol=1e-8)
    assert all(r[np.abs(r).argmax()] > 0 for r in w)
    assert np.allclose(np.abs(values(model.transform(df))), np.abs((x - x.mean(0)) @ vt[:3].T), atol=1e-5)
    full = s ** 2 / (s ** 2).sum()
    assert np.allclose(model.state["ratio"], full[:3])
    k = len(np.atleast_2d(PCA(variance=0.9).fit(df).state["components"]))
    assert k == np.searchsorted(np.cumsum(full), 0.9, side="right") + 1


@pytest.mark.parametrize("shape", [(300, 40), (60, 50)])
def test_wide_pca_without_the_full_matrix_matches_svd(spark, monkeypatch, shape):
    monkeypatch.setattr(reduce, "MAX_WIDTH", 16)
    rng = np.random.default_rng(1)
    x = rng.normal(size=shape) @ np.diag(3.0 * 0.8 ** np.arange(shape[1])) + 1000
    df = vectors(spark, x)
    _, s, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    full = s ** 2 / (s ** 2).sum()
    model = PCA(n_components=4).fit(df)
    w = np.atleast_2d(model.state["components"])
    assert np.allclose(np.abs(w), np.abs(vt[:4]), atol=1e-4)
    assert np.allclose(w @ w.T, np.eye(4), atol=1e-8)
    assert np.allclose(model.state["ratio"], full[:4], atol=1e-7) and np.allclose(model.state["mean"], x.mean(0))
    monkeypatch.setattr(reduce, "FIRST_AXES", 2)
    k = len(np.atleast_2d(PCA(variance=0.97).fit(df).state["components"]))
    assert k == np.searchsorted(np.cumsum(full), 0.97, side="right") + 1


def test_wide_pca_of_constant_rows(spark, monkeypatch):
    monkeypatch.setattr(reduce, "MAX_WIDTH", 2)
    model = PCA(n_components=2).fit(vectors(spark, [[1.0, 2.0, 3.0]] * 5))
    assert list(model.state["ratio"]) == [0.0, 0.0]
    with pytest.raises(ValueError):
        PCA(variance=1.5).fit(vectors(spark, np.eye(3)))


@pytest.mark.parametrize("op", ["sum", "min"])
def test_arrays_are_merged_block_by_block_over_several_stages(spark, monkeypatch, op):
    monkeypatch.setattr(partials, "BLOCK", 7)
    monkeypatch.setattr(partials, "FAN", 2)  # four cores: two slots, so two merge stages
    x = np.random.default_rng(2).integers(-50, 50, (90, 23)).astype(float)

    def fold(batches):
        rows = [matrix(b.column("features")) for b in batches if b.num_rows]
        rows = np.concatenate(rows) if rows else np.zeros((0, 23))
        return {"wide": rows.sum(axis=0) if op == "sum" else rows.min(axis=0, initial=0.0), "none": np.zeros(0), "one": np.array([float(len(rows))])}

    got = partials.reduce_arrays(vectors(spark, x, partitions=9).select("features"), fold, op)
    assert np.array_equal(got["wide"], x.sum(axis=0) if op == "sum" else np.minimum(x.min(axis=0), 0.0))
    assert got["none"].size == 0 and (op == "min" or got["one"][0] == 90)


def test_lookup_measures_the_bytes_of_its_rows(spark, monkeypatch):
    """A few long rows are not broadcast, however few they are."""
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 10_000)
    rows = spark.createDataFrame([(i % 3, i) for i in range(30)], "k int, id int")
    short = spark.createDataFrame([(i, "v", [1.0], i + 1) for i in range(3)], "k int, v string, a array<double>, n int")
    long = spark.createDataFrame([(i, "v" * 5000, [1.0], i + 1) for i in range(3)], "k int, v string, a array<double>, n int")
    wide = spark.createDataFrame([(i, "v", [1.0] * 2000, i + 1) for i in range(3)], "k int, v string, a array<double>, n int")
    for table, broadcast in ((short, True), (long, False), (wide, False)):
        out = lookup.keyed_lookup(rows, table, "k", "n")
        assert {(r["id"], len(r["v"]), len(r["a"])) for r in out.collect()} == {
            (i, *table.select(F.length("v"), F.size("a")).first()) for i in range(30)}
        plan = out._jdf.queryExecution().analyzed().toString()
        assert ("_spread" not in plan) == broadcast


def test_pca_rejects_too_many_components(spark):
    with pytest.raises(ValueError):
        PCA(n_components=5).fit(vectors(spark, np.eye(3)))


def _pipeline_rows(spark, n=300):
    rng = np.random.default_rng(5)
    rows = [(i, "xyz"[i % 3], float(rng.normal()), float(rng.normal()), bool(i % 2), float(rng.normal() + i % 3)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, c string, a double, b double, flag boolean, label double")


def test_feature_pipeline_matches_numpy_and_passes_other_columns(spark):
    df = _pipeline_rows(spark)
    model = FeaturePipeline(keys=["id"], variance=0.9).fit(df)
    out = model.transform(df)
    assert set(df.columns) < set(out.columns) and "flag" in out.columns
    pdf = df.orderBy("id").toPandas()
    enc = pdf.groupby("c")["label"].transform("mean").to_numpy()
    a, b = pdf["a"].to_numpy(), pdf["b"].to_numpy()
    z = np.column_stack([enc, a, b, enc * a, enc * b, a * b])
    z = (z - z.mean(0)) / z.std(0)
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    k = np.searchsorted(np.cumsum(s ** 2 / (s ** 2).sum()), 0.9, side="right") + 1
    assert model.n_components == k
    assert np.allclose(np.abs(values(out)), np.abs(z @ vt[:k].T), atol=1e-6)


def test_feature_pipeline_learns_from_training_rows_only(spark):
    df = holdout_split(_pipeline_rows(spark), ["id"])
    changed = df.withColumn("label", F.when(F.col("is_test"), F.lit(1e6)).otherwise(F.col("label")))
    fits = [FeaturePipeline(keys=["id", "is_test"]).fit(d.filter("not is_test")) for d in (df, changed)]
    a, b = (values(m.transform(df)) for m in fits)
    assert np.allclose(a, b)


def test_feature_pipeline_save_load_and_new_categories(spark, tmp_path):
    df = _pipeline_rows(spark)
    model = FeaturePipeline(keys=["id"]).fit(df)
    model.save(str(tmp_path / "m"))
    again = FeaturePipelineModel.load(str(tmp_path / "m"))
    new = df.withColumn("c", F.lit("never seen"))
    assert np.allclose(values(model.transform(new)), values(again.transform(new)))
    no_label = FeaturePipeline(keys=["id"], use_label=False).fit(df)
    assert no_label.get("numeric") == ["a", "b"]


def test_linear_map_and_pca_models_reload(spark, tmp_path):
    df = vectors(spark, np.random.default_rng(0).normal(size=(30, 3)))
    for cls, model in ((LinearMapModel, StandardScale().fit(df)), (PCAModel, PCA(n_components=2).fit(df))):
        path = str(tmp_path / cls.__name__)
        model.save(path)
        assert np.allclose(values(cls.load(path).transform(df)), values(model.transform(df)))
