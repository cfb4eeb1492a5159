import numpy as np
import pytest
from frames import r2, vectors
from pyspark.sql import functions as F

from fitmesh.models.neighbours import KNN, KNNModel
from fitmesh.operators import lookup
from fitmesh.operators.knn import knn_join
from fitmesh.operators.lsh import lsh_knn_join
from fitmesh.operators.outliers import IsolationForest, KMeansOutlier, LocalOutlierFactor, drop_small_groups, local_outlier_factor


def brute(q, qid, b, bid, k, itself):
    out = {}
    for i, x in zip(qid, q):
        cand = sorted((float(np.sqrt(((x - y) ** 2).sum())), j) for j, y in zip(bid, b) if not (itself and i == j))
        out[i] = cand[:k]
    return out


def collected(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["distance"], r["neighbor_id"]))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for i in want:
        assert [j for _, j in got[i]] == [j for _, j in want[i]], i
        assert np.allclose([d for d, _ in got[i]], [d for d, _ in want[i]])


@pytest.mark.parametrize("pivots,block", [(1, 7), (6, 4096), (9, 5)])
def test_self_join_with_copies_and_ties(spark, pivots, block):
    rng = np.random.default_rng(pivots)
    x = np.concatenate([rng.integers(0, 4, (60, 2)), np.tile([[1, 1]], (45, 1)), rng.normal(size=(30, 2)) * 50]).astype(float)
    got = collected(knn_join(vectors(spark, x), None, 4, pivots=pivots, block_rows=block))
    same(got, brute(x, range(len(x)), x, range(len(x)), 4, True))


@pytest.mark.parametrize("pivots", [5])
def test_query_and_base_differ(spark, pivots):
    rng = np.random.default_rng(2)
    b, q = rng.normal(size=(80, 5)), rng.normal(size=(30, 5)) + 3
    got = collected(knn_join(vectors(spark, q), vectors(spark, b), 3, pivots=pivots, block_rows=16))
    same(got, brute(q, range(30), b, range(80), 3, False))


def test_string_ids_and_more_neighbours_than_rows(spark):
    x = np.arange(5.0)[:, None]
    ids = [f"r{i}" for i in range(5)]
    got = collected(knn_join(vectors(spark, x, ids=ids), None, 10))
    assert all(len(v) == 4 for v in got.values()) and got["r0"][0] == (1.0, "r1")


def test_hot_copies_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    x = np.concatenate([np.zeros((50, 2)), np.random.default_rng(0).normal(size=(60, 2))])
    same(collected(knn_join(vectors(spark, x), None, 3, pivots=4)), brute(x, range(110), x, range(110), 3, True))


@pytest.mark.parametrize("weights", ["uniform", "distance"])
def test_knn_regression(spark, tmp_path, weights):
    rng = np.random.default_rng(4)
    x = rng.uniform(-1, 1, (120, 2))
    y = x[:, 0] * 3 + x[:, 1]
    q = np.concatenate([rng.uniform(-1, 1, (20, 2)), x[:2]])  # two exact matches
    model = KNN(n_neighbors=3, weights=weights).fit(vectors(spark, x, y))
    got = [r["prediction"] for r in model.transform(vectors(spark, q)).orderBy("id").collect()]
    want = []
    for i, cand in brute(q, range(22), x, range(120), 3, False).items():
        d, labels = np.array([c[0] for c in cand]), y[[c[1] for c in cand]]
        if weights == "uniform":
            want.append(labels.mean())
        else:
            want.append(labels[d == 0].mean() if (d == 0).any() else (labels / d).sum() / (1 / d).sum())
    assert np.allclose(got, want)
    model.save(str(tmp_path / "m"))
    again = [r["prediction"] for r in KNNModel.load(str(tmp_path / "m")).transform(vectors(spark, q)).orderBy("id").collect()]
    assert np.allclose(got, again)


def lof(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :k]
    dist = np.take_along_axis(d, near, 1)
    reach = np.maximum(dist[near, -1], dist)
    lrd = 1 / (reach.mean(1) + 1e-10)
    return lrd[near].mean(1) / lrd


@pytest.mark.parametrize("pivots", [4])
def test_lof_matches_numpy(spark, pivots):
    x = np.random.default_rng(1).normal(size=(90, 3))
    got = local_outlier_factor(vectors(spark, x), 10, "id", "features", pivots=pivots, block_rows=25).orderBy("id").collect()
    assert np.allclose([r["lof"] for r in got], lof(x, 10))


def outlier_frame():
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(0, 0.3, (150, 2)), rng.normal(6, 0.3, (150, 2)), rng.uniform(20, 40, (9, 2))])
    return x, np.arange(309) >= 300


@pytest.mark.parametrize("estimator", [
    LocalOutlierFactor(n_neighbors=20), IsolationForest(contamination=0.03), KMeansOutlier(n_clusters=3, n_init=3)])
def test_far_points_are_dropped_with_their_labels(spark, estimator):
    x, far = outlier_frame()
    df = vectors(spark, x, far)
    kept = estimator.clean(df)
    assert kept.columns == df.columns
    labels = [r["label"] for r in kept.collect()]
    assert sum(labels) == 0 and len(labels) >= 270


def test_isolation_forest_is_independent_of_partitioning_and_scores_new_rows(spark):
    x, _ = outlier_frame()
    models = [IsolationForest(n_estimators=20, max_samples=64).fit(vectors(spark, x, partitions=p)) for p in (1, 6)]
    new = vectors(spark, [[0.0, 0.0], [100.0, 100.0]])
    a, b = ([r["score"] for r in m.transform(new).orderBy("id").collect()] for m in models)
    assert a == b and a[1] > 0.6 > a[0]


def test_small_groups(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 5, "rare").when(F.col("id") < 50, None).otherwise("big").alias("g"))
    assert drop_small_groups(df, "g", 0.05).count() == 100  # exactly at the ratio stays
    assert drop_small_groups(df, "g", 0.06).count() == 95   # null is a group of its own


def test_knn_finds_the_signal(spark):
    from frames import signal

    x, y = signal(600)
    model = KNN(n_neighbors=5, weights="distance").fit(vectors(spark, x[:450], y[:450]))
    p = [r["prediction"] for r in model.transform(vectors(spark, x[450:])).orderBy("id").collect()]
    assert r2(y[450:], np.array(p)) > 0.9


def test_integer_ids_keep_their_type(spark):
    df = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(6)], "id int, features array<double>")
    got = {r["query_id"]: r["neighbor_id"] for r in knn_join(df, None, 1).collect()}
    assert got[0] == 1 and got[5] == 4


def recall(got, want):
    return sum(len({j for _, j in got[i]} & {j for _, j in w}) for i, w in want.items()) / sum(map(len, want.values()))


def test_hashed_neighbours_recall_and_distances(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 32)) * 3
    x = centres[rng.integers(0, 30, 1500)] + rng.normal(size=(1500, 32))
    got = collected(lsh_knn_join(vectors(spark, x), None, 5, bucket_rows=64))
    want = brute(x, range(len(x)), x, range(len(x)), 5, True)
    assert {i: len(g) for i, g in got.items()} == {i: 5 for i in want} and recall(got, want) >= 0.9
    assert all(np.isclose(d, np.sqrt(((x[i] - x[j]) ** 2).sum())) for i, g in got.items() for d, j in g)


def test_hashed_neighbours_of_other_rows_copies_and_few_points(spark):
    rng = np.random.default_rng(4)
    base = np.concatenate([np.zeros((400, 3)), rng.normal(size=(100, 3)), np.full((3, 3), 1e6)])
    asked = np.concatenate([np.zeros((50, 3)), rng.normal(size=(40, 3)), [[1e6, 1e6, 1e6], [-1e9, 0, 0]]])
    ids = [f"b{i:04d}" for i in range(len(base))]
    got = collected(lsh_knn_join(vectors(spark, asked), vectors(spark, base, ids=ids), 4, bucket_rows=16, tables=8))
    want = brute(asked, range(len(asked)), base, ids, 4, False)
    assert recall(got, want) >= 0.9
    same({i: got[i] for i in (0, 49, 90, 91)}, {i: want[i] for i in (0, 49, 90, 91)})  # copies, a far group, and one that finds no bucket
    few = vectors(spark, base[:3] + [[0, 0, 0], [1, 0, 0], [5, 0, 0]])
    same(collected(lsh_knn_join(few, None, 5)), brute(base[:3] + [[0, 0, 0], [1, 0, 0], [5, 0, 0]], range(3), base[:3] + [[0, 0, 0], [1, 0, 0], [5, 0, 0]], range(3), 5, True))


def test_hashed_work_grows_with_the_rows(spark):
    from fitmesh.operators import lsh

    def met(n):
        x = np.random.default_rng(n).normal(size=(n, 64))
        points = vectors(spark, x).select(F.col("id").alias("pid"), F.col("features").alias("vec"))
        t = lsh._Tables(np.zeros(64), 8.0, 4, 2.0, 1)
        buckets, levels = lsh._bucketed(points, t, 64)
        probed = points.withColumnRenamed("pid", "qid").mapInArrow(lsh._probe_keys(t, levels, 2), "qid long, key long").distinct()
        return probed.join(buckets, "key").count()

    assert met(3200) < 3 * met(1600)


def test_hashed_neighbours_in_regression_and_density(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 8))
    x[:5] += 40 + 20 * np.arange(5)[:, None]
    df = vectors(spark, x, x[:, 0])
    exact, hashed = (KNN(algorithm=a).fit(df).transform(df).toPandas().sort_values("id")["prediction"].to_numpy() for a in ("auto", "lsh"))
    assert np.mean(np.isclose(exact, hashed)) > 0.8
    out = LocalOutlierFactor(algorithm="lsh").mask(df).where("not is_inlier").select("id").toPandas()["id"]
    assert set(range(5)) <= set(out)


def test_candidates_travel_without_their_vectors(monkeypatch):
    """A block's candidates carry the query's number, and columns met piece by piece give the same neighbours."""
    import pyarrow as pa

    from fitmesh.functions.vectors import list_column
    from fitmesh.operators import knn

    rng = np.random.default_rng(4)
    q, b = rng.integers(0, 4, (40, 3)).astype(float), np.unique(rng.integers(0, 9, (300, 3)), axis=0).astype(float)  # with ties
    left = pa.table({"qid": pa.array(np.arange(40) + 7), "query": list_column(q)})
    right = pa.table({"vec": list_column(b), "ids": pa.array([[i] for i in range(len(b))], pa.list_(pa.int64()))})
    for columns in (8192, 11):
        monkeypatch.setattr(knn, "_COLUMNS", columns, raising=False)
        found = knn._meet(5, pa.int64())(left, right)
        assert found.column_names == ["qid", "distance", "id"]
        got = {}
        for i, d, who in zip(*(found.column(c).to_pylist() for c in found.column_names)):
            got.setdefault(i - 7, []).append((d, who))
        for i, v in enumerate(q):
            want = sorted(zip(np.sqrt(((b - v) ** 2).sum(axis=1)), range(len(b))))[:5]
            assert [w for _, w in sorted(got[i])] == [w for _, w in want]


def test_nearest_columns_in_either_precision():
    """Single precision must lose no neighbour: far groups, copies and tiny values go on in double precision or let more pairs through."""
    from fitmesh.operators import knn

    rng = np.random.default_rng(5)
    near = rng.standard_normal((400, 6))
    for b in (near, np.concatenate([near, near + 1e6]), near * 1e-15, near * 1e20, rng.integers(0, 3, (400, 6)).astype(float), np.zeros((9, 6))):
        q, k = b[::7], 5
        row, col = knn.nearest_columns(q - b.mean(0), b - b.mean(0), k)
        for i in range(len(q)):
            d = np.sqrt(((q[i] - b) ** 2).sum(-1))
            assert set(np.flatnonzero(d <= np.sort(d)[k - 1])) <= set(col[row == i])


def test_probe_keys_of_leaves_only():
    """Only keys of buckets in use leave the task: with 24 levels all others are 1920 rows a query."""
    import pyarrow as pa

    from fitmesh.operators import lsh

    x = np.random.default_rng(3).standard_normal((50, 8))
    t = lsh._Tables(x.mean(0), 2.8, 4, 2.0, 1)
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(list(x))], names=["qid", "vec"])
    cell, place = t.cells(x)
    side, edge, want = np.where(place < 0.5, -1, 1), np.minimum(place, 1 - place), set()
    for i in range(50):
        for level in range(6):
            for flip in [None, *np.ndindex(4)]:
                for table in range(4):
                    other = cell[i : i + 1].copy()
                    if flip is not None:
                        near = np.argsort(edge[i, table, : level + 1])[:2]
                        if flip[0] >= len(near[:2]):
                            continue
                        other[0, table, near[flip[0]]] += side[i, table, near[flip[0]]]
                    want.add((i, int(t.keys(other)[0, table, level])))
    rows = lambda leaves: [p for b in lsh._probe_keys(t, 6, 2, leaves)([batch]) for p in zip(*(c.to_pylist() for c in b.columns))]
    every = rows(None)
    assert set(every) == want and len(every) == len(want)
    leaves = np.sort(t.keys(cell)[:, :, 3].ravel())
    assert set(rows(leaves)) == {p for p in want if p[1] in set(leaves.tolist())}


def _shuffled(spark):
    """Bytes of shuffle files on disk."""
    import os

    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(os.path.getsize(os.path.join(at, f)) for d in folders for at, _, files in os.walk(d) for f in files if f.startswith("shuffle_"))


def test_blocks_and_buckets_meet_in_rounds(spark, monkeypatch):
    """Rounds give the neighbours that one meeting gives; their shuffle files and all but the last of their results go."""
    from fitmesh.operators import knn, lsh

    x = np.concatenate([np.random.default_rng(7).normal(size=(400, 8)), np.zeros((30, 8))])
    df = vectors(spark, x).withColumn("features", F.col("features").cast("array<float>")).cache()
    x = np.array([r["features"] for r in df.orderBy("id").collect()])
    joins = (lambda: knn_join(df, None, 4, pivots=3, block_rows=40), lambda: lsh_knn_join(df, None, 4, bucket_rows=64, tables=4))
    want = brute(x, range(len(x)), x, range(len(x)), 4, True)
    once = [collected(j()) for j in joins]
    same(once[0], want)
    gone = []
    for module, size in ((knn, 80_000), (lsh, 250_000)):
        monkeypatch.setattr(module, "ROUND_BYTES", size)
        monkeypatch.setattr(module, "ROUND_TIMES", 0)
        monkeypatch.setattr(module, "released", lambda t, real=module.released: gone.append(t) or real(t))
    for join, before in zip(joins, once):
        had = _shuffled(spark)
        df_out = join()
        assert _shuffled(spark) - had < 20_000 and len(gone) > 2
        gone.clear()
        same(collected(df_out), before)
    df.unpersist()
