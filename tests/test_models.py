import numpy as np
import pytest
from frames import r2, signal, vectors
from pyspark.sql import functions as F

from fitmesh.models.adaboost import AdaBoost, AdaBoostModel, draw_rows
from fitmesh.models.extratrees import ExtraTrees, ExtraTreesModel
from fitmesh.models.grouped import fit_by_group, predict_by_group
from fitmesh.models.linear import OLS, ElasticNet, Lasso, LinearModel, Ridge
from fitmesh.models.mlp import MLP, MLPModel
from fitmesh.models.svr import SVR, SVRModel
from fitmesh.models import cart
from fitmesh.models.cart import TreesModel
from fitmesh.models.boosting import BoostedModel, LightGBM, XGBoost
from fitmesh.models.trees import DecisionTree, GradientBoosting, NativeTreeModel, RandomForest
from fitmesh.models.user import UserModel, UserRegressor
from fitmesh.session import durable
from fitmesh.queries.outputs import mean_finish, mean_partial, mean_predict


def predictions(model, df):
    return np.array([r["prediction"] for r in model.transform(df).orderBy("id").collect()])


@pytest.mark.parametrize("shape", [(100, 3), (100, 80), (30, 600)])
def test_ols_and_ridge_match_closed_form(spark, shape):
    rng = np.random.default_rng(0)
    x = rng.normal(size=shape) + 1000
    y = x @ rng.normal(size=shape[1]) + rng.normal(size=shape[0])
    df = vectors(spark, x, y)
    xc, yc = x - x.mean(0), y - y.mean()
    assert np.allclose(OLS().fit(df).state["coefficients"], np.linalg.lstsq(xc, yc, rcond=1e-10)[0], atol=1e-6)
    ridge = np.linalg.solve(xc.T @ xc + 2.0 * np.eye(shape[1]), xc.T @ yc)
    model = Ridge(alpha=2.0).fit(df)
    assert np.allclose(model.state["coefficients"], ridge, atol=1e-6)
    assert np.allclose(predictions(model, df), xc @ ridge + y.mean())


def test_constant_and_duplicate_columns(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=50)
    x = np.column_stack([a, np.full(50, 3.0), a])
    df = vectors(spark, x, 4 * a + 1)
    w = OLS().fit(df).state["coefficients"]
    assert np.allclose(w, [2.0, 0.0, 2.0])
    assert np.allclose(predictions(OLS().fit(df), df), 4 * a + 1)


def test_lasso_and_elastic_net_satisfy_their_optimality_conditions(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 6))
    y = 3 * x[:, 0] - 2 * x[:, 3] + 0.1 * rng.normal(size=200)
    df = vectors(spark, x, y)
    xc, yc = x - x.mean(0), y - y.mean()
    for model, l1, l2 in ((Lasso(alpha=0.1).fit(df), 0.1, 0.0), (ElasticNet(alpha=0.2, l1_ratio=0.5).fit(df), 0.1, 0.1)):
        w = model.state["coefficients"]
        g = xc.T @ (yc - xc @ w) / 200 - l2 * w
        assert np.allclose(g[w != 0], l1 * np.sign(w[w != 0]), atol=1e-8)
        assert np.all(np.abs(g[w == 0]) <= l1 + 1e-8) and (w == 0).sum() >= 3


def test_one_row_and_empty_input(spark):
    one = vectors(spark, [[2.0, 3.0]], [7.0])
    assert predictions(OLS().fit(one), one)[0] == 7.0
    with pytest.raises(ValueError):
        OLS().fit(vectors(spark, np.zeros((0, 2))))


FAMILIES = [
    (DecisionTree(max_depth=8), TreesModel, 0.9), (RandomForest(n_estimators=10, min_samples_split=4), TreesModel, 0.9), (RandomForest(n_estimators=10, max_depth=8), NativeTreeModel, 0.9),
    (GradientBoosting(n_estimators=15, learning_rate=0.5), NativeTreeModel, 0.9),
    (XGBoost(n_estimators=8, max_depth=5), BoostedModel, 0.9), (LightGBM(n_estimators=8, num_leaves=32, learning_rate=0.5), BoostedModel, 0.9),
    (AdaBoost(n_estimators=6, max_depth=5), AdaBoostModel, 0.8), (ExtraTrees(n_estimators=15, max_depth=9), ExtraTreesModel, 0.9),
    (SVR(C=10.0, n_components=100, max_iter=10), SVRModel, 0.95), (MLP(hidden_layer_sizes=[20], solver="lbfgs", max_iter=25), MLPModel, 0.85),
    (MLP(hidden_layer_sizes=[20], max_iter=30), MLPModel, 0.6),
]


@pytest.mark.parametrize("estimator,cls,floor", FAMILIES, ids=lambda v: type(v).__name__ if hasattr(v, "fit") else None)
def test_family_reaches_its_floor_and_reloads(spark, tmp_path, estimator, cls, floor):
    x, y = signal(1500)
    model = estimator.fit(vectors(spark, x[:1200], y[:1200]))
    test = vectors(spark, x[1200:], y[1200:])
    p = predictions(model, test)
    assert r2(y[1200:], p) > floor
    assert abs(model.score(test) - r2(y[1200:], p)) < 1e-9
    model.save(str(tmp_path / "m"))
    assert np.allclose(predictions(cls.load(str(tmp_path / "m")), test), p)


def plain_boosting(x, y, rounds, rate, penalty, least, leaves, depth):
    """Boosting with exact splits, in plain Python."""
    p = np.full(len(y), y.mean())
    for _ in range(rounds):
        r = y - p

        def best(rows):
            out = None
            for f in range(x.shape[1]):
                for cut in np.unique(x[rows, f])[:-1]:
                    go = x[rows, f] <= cut
                    if go.sum() >= least and (~go).sum() >= least:
                        score = lambda v: v.sum() ** 2 / (len(v) + penalty)
                        gain = score(r[rows][go]) + score(r[rows][~go]) - score(r[rows])
                        if gain > 1e-9 and (out is None or gain > out[0] + 1e-9):
                            out = (gain, rows[go], rows[~go])
            return out

        final, queue = [], [(np.arange(len(y)), 0)]
        done = [(best(rows), rows, d) for rows, d in queue]
        while True:
            able = [n for n in done if n[0] is not None and (depth <= 0 or n[2] < depth)]
            if not able or (leaves is not None and len(done) >= leaves):
                break
            node = max(able, key=lambda n: n[0][0])
            done = [n for n in done if n is not node] + [(best(rows), rows, node[2] + 1) for rows in node[0][1:]]
        for _, rows, _ in done:
            p[rows] += rate * r[rows].sum() / (len(rows) + penalty)
    return p


@pytest.mark.parametrize("estimator, leaves, depth, penalty, least", [
    (XGBoost(n_estimators=10, max_depth=3, learning_rate=0.5), None, 3, 1.0, 1), (XGBoost(n_estimators=2, max_depth=0, reg_lambda=5.0, min_child_weight=6.0), None, 0, 5.0, 6),
    (LightGBM(n_estimators=9, num_leaves=5, learning_rate=0.5, min_child_samples=3), 5, -1, 0.0, 3), (LightGBM(n_estimators=2, num_leaves=9, max_depth=2, reg_lambda=2.0), 9, 2, 2.0, 20)])
def test_boosting_equals_plain_python(spark, monkeypatch, estimator, leaves, depth, penalty, least):
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.integers(0, 9, 160), rng.normal(size=160), np.zeros(160)]).astype(float)
    y = x[:, 0] ** 2 + 3 * np.sin(2 * x[:, 1]) + rng.normal(0, 0.1, 160)
    rounds, rate = estimator.get("n_estimators"), estimator.get("learning_rate")
    want = plain_boosting(x, y, rounds, rate, penalty, least, leaves, depth)
    df = vectors(spark, x, y)
    assert np.allclose(predictions(estimator.fit(df), df), want)
    monkeypatch.setattr("fitmesh.models.boosting._STATE_BYTES", 1)  # one open node a pass
    assert np.allclose(predictions(estimator.fit(df), df), want)


def test_binned_rows_travel_in_blocks(spark):
    from fitmesh.operators.packed import blocks, pack

    x = np.random.default_rng(2).normal(size=(500, 2))
    cuts = [np.linspace(-1, 1, 9), np.linspace(-2, 2, 300)]  # the second needs two bytes a bin
    for c in (cuts, cuts[:1] * 2):
        packed = pack(vectors(spark, x, x[:, 0]).selectExpr("features as x", "label as y"), c, ["y"], {"m": 3.0}).toArrow()
        assert packed.num_rows == 4
        found = [(y, m, *b) for bins, y, m in map(list, blocks(2, {"y": np.float64, "m": np.float64})(packed.to_batches())) for b, y, m in zip(bins, y, m)]
        assert sorted(found) == sorted((v[0], 3.0, *(np.searchsorted(k, a, "left") for k, a in zip(c, v))) for v in x)


def test_rows_travel_in_blocks_before_they_are_binned(spark, monkeypatch):
    from fitmesh.operators import packed
    from fitmesh.operators.orderstats import block_order_statistics

    x = np.random.default_rng(4).normal(size=(500, 2))
    x[3, 1] = np.nan
    df = vectors(spark, x, x[:, 0]).selectExpr("features as x", "if(label > 1, null, label) as y", "cast(label * 1000 as bigint) as r")
    for size in (4 << 20, 32 * 20):  # 20 rows a block
        monkeypatch.setattr(packed, "_BLOCK_BYTES", size)
        table = packed.pack_rows(df, 2, ["y", "r"]).cache()
        assert table.agg({"n": "sum"}).first()[0] == 500 and table.count() <= (8 if size > 1000 else 40)
        known = table.where("y is not null")
        rows = [(*b, y, r) for v in packed.row_blocks(2, {"y": np.float64, "r": np.int64})(known.toArrow().to_batches()) for b, y, r in zip(*v)]
        assert np.allclose(sorted(rows), sorted((*v, v[0], int(v[0] * 1000)) for v in x if v[0] <= 1), equal_nan=True)
        n, mean = packed.count_and_mean(table, "y")
        assert n == (x[:, 0] <= 1).sum() and np.isclose(mean, x[x[:, 0] <= 1, 0].mean())
        totals, found = block_order_statistics(table, 2, [0, 1], lambda c, n: [0, n // 2])
        for j in (0, 1):
            values = np.sort(x[~np.isnan(x[:, j]), j])
            assert totals[j] == len(values) and found[j] == {0: values[0], len(values) // 2: values[len(values) // 2]}
        cuts = [np.linspace(-1, 1, 9), np.linspace(-2, 2, 300)]
        binned = [sorted((y, *b) for bins, y in packed.blocks(2, {"y": np.float64})(t.toArrow().to_batches()) for b, y in zip(bins, y))
                  for t in (packed.pack_blocks(known, cuts, ["y"]), packed.pack(df.where("y is not null"), cuts, ["y"]))]
        assert binned[0] == binned[1]
        table.unpersist()


@pytest.mark.parametrize("fit", [DecisionTree(max_depth=3), RandomForest(n_estimators=2, max_depth=3, min_samples_split=3), XGBoost(n_estimators=1, max_depth=2)])
def test_trees_write_and_read_blocks_of_rows(spark, monkeypatch, fit):
    from fitmesh.models import boosting

    written = []
    for module in (cart, boosting):
        monkeypatch.setattr(module, "durable", lambda df, real=module.durable: written.append(real(df)) or written[-1])
    monkeypatch.setattr(cart, "HAND_OVER", 100)
    x, y = signal(3000)
    fit.fit(vectors(spark, x, y))
    parts = 2 * spark.sparkContext.defaultParallelism
    assert len(written) >= 2 and all(t.count() <= max(parts, 30) for t in written)


def plain_tree(x, y, depth, least):
    p = np.zeros(len(y))

    def grow(rows, level):
        p[rows] = y[rows].mean()
        best = None
        if len(rows) >= max(least, 2) and (depth is None or level < depth):
            for f in range(x.shape[1]):
                for cut in np.unique(x[rows, f])[:-1]:
                    go = x[rows, f] <= cut
                    lost = y[rows][go].var() * go.sum() + y[rows][~go].var() * (~go).sum()
                    if best is None or lost < best[0] - 1e-9:
                        best = (lost, rows[go], rows[~go])
        if best is not None and best[0] < y[rows].var() * len(rows) - 1e-12:
            grow(best[1], level + 1)
            grow(best[2], level + 1)

    grow(np.arange(len(y)), 0)
    return p


@pytest.mark.parametrize("depth, least, hand_over", [(None, 2, 20_000), (None, 10, 20_000), (3, 2, 20_000), (None, 7, 40), (4, 2, 25)])
def test_tree_equals_plain_python(spark, monkeypatch, depth, least, hand_over):
    monkeypatch.setattr(cart, "HAND_OVER", hand_over)
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(0, 30, 150), rng.normal(size=150), np.ones(150)]).astype(float)
    y = x[:, 0] * 2 + np.sin(3 * x[:, 1]) + rng.normal(0, 0.1, 150)
    df = vectors(spark, x, y)
    assert np.allclose(predictions(DecisionTree(max_depth=depth, min_samples_split=least).fit(df), df), plain_tree(x, y, depth, least))


@pytest.mark.parametrize("fit", [dict(max_depth=4), dict(min_samples_split=20)])
def test_tree_does_not_depend_on_what_is_handed_over(spark, monkeypatch, fit):
    """Large nodes, cut with the help of a few bins, give the tree that one task grows from all rows, on new rows as well."""
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.normal(size=1200), rng.integers(0, 9, 1200), rng.exponential(size=1200).round(1)])
    y = np.where(x[:, 0] > 0.317, 3.0, 0.0) + np.where(x[:, 2] > 1.7, 1.0, 0.0) + rng.normal(0, 0.3, 1200)
    df, new = vectors(spark, x, y), vectors(spark, np.column_stack([rng.normal(size=2000), rng.uniform(-1, 9, 2000), rng.exponential(size=2000)]))
    whole = predictions(DecisionTree(**fit).fit(df), new)
    monkeypatch.setattr(cart, "HAND_OVER", 150)
    monkeypatch.setattr(cart, "_BINS", 6)
    assert np.allclose(predictions(DecisionTree(**fit).fit(df), new), whole)


def test_a_node_of_ten_is_cut_one_to_nine(spark):
    y = np.array([0.0] * 9 + [100.0])
    df = vectors(spark, np.arange(10.0)[:, None], y)
    assert np.allclose(predictions(DecisionTree(min_samples_split=10).fit(df), df), y)
    assert np.allclose(predictions(DecisionTree(min_samples_split=11).fit(df), df), 10.0)


def test_large_leaves_are_not_moved_to_one_task(spark, monkeypatch):
    """Leaves at the depth limit take their value from sums; a node of one label is a leaf however large; bins follow a crowded node."""
    moved, finish = [], cart._finish
    monkeypatch.setattr(cart, "_finish", lambda data, part, *rest: moved.extend(len(t.handed) for t in part) or finish(data, part, *rest))
    monkeypatch.setattr(cart, "HAND_OVER", 30)
    x = np.repeat([0.0, 1.0, 2.0, 3.0], 60)[:, None]
    y = np.repeat([1.0, 5.0, 20.0, 30.0], 60)
    df = vectors(spark, x, y)
    assert np.allclose(predictions(DecisionTree(max_depth=1).fit(df), df), np.repeat([3.0, 25.0], 120))
    assert np.allclose(predictions(DecisionTree().fit(df), df), y)
    assert not sum(moved)
    monkeypatch.setattr(cart, "_BINS", 8)
    x = np.concatenate([np.linspace(0, 1e-3, 200), [5.0]])[:, None]
    y = np.where(np.arange(201) % 2, 1.0, -1.0) * np.where(np.arange(201) < 100, 1, 4)
    df = vectors(spark, x, y)
    assert np.allclose(predictions(DecisionTree().fit(df), df), y)


def test_subtrees_of_a_large_tree_stay_a_table(spark, monkeypatch, tmp_path):
    x, y = signal(400)
    df = vectors(spark, x, y)
    monkeypatch.setattr(cart, "HAND_OVER", 60)
    whole = DecisionTree(min_samples_split=5).fit(df)
    monkeypatch.setattr(cart, "MAX_NODES", 10)
    model = DecisionTree(min_samples_split=5).fit(df)
    assert model.subtrees is not None and len(model.state["value"]) < 60
    model.write().save(str(tmp_path / "m"))
    again = TreesModel.load(str(tmp_path / "m"))
    assert model.transform(df).columns == whole.transform(df).columns
    for m in (model, again):
        assert np.allclose(predictions(m, df), predictions(whole, df))


def test_deep_trees_and_bootstrap(spark, monkeypatch):
    n = 60
    y = np.where(np.arange(n) % 2, 1.0, -1.0) * 2.0 ** np.arange(n)  # each cut takes off the last value: depth n - 1
    df = vectors(spark, np.arange(float(n))[:, None], y)
    assert np.allclose(predictions(DecisionTree().fit(df), df), y)
    w = cart.bootstrap_weights(np.random.default_rng(1).integers(0, 2**63, 100_000).astype(np.uint64), 3)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.01
    x, y = signal(400)
    df = vectors(spark, x, y)
    a = predictions(RandomForest(n_estimators=3, bootstrap=False).fit(df), df)
    monkeypatch.setattr(cart, "HAND_OVER", 50)
    b = predictions(RandomForest(n_estimators=8, max_features="sqrt").fit(df), df)
    assert np.allclose(a, y) and r2(y, b) > 0.7


def test_boosting_subsamples_rows_and_handles_constant_data(spark):
    x, y = signal(800)
    df = vectors(spark, x, y)
    some, whole = (predictions(XGBoost(n_estimators=3, subsample=s).fit(df), df) for s in (0.5, 1.0))
    assert not np.allclose(some, whole) and r2(y, some) > 0.4
    flat = vectors(spark, np.ones((30, 2)), np.full(30, 4.0))
    assert np.allclose(predictions(LightGBM(n_estimators=2).fit(flat), flat), 4.0)
    with pytest.raises(ValueError):
        XGBoost().fit(vectors(spark, np.zeros((0, 2))))


def test_extra_trees_do_not_depend_on_partitioning(spark):
    x, y = signal(300)
    new = vectors(spark, x[:20])
    a, b = (predictions(ExtraTrees(n_estimators=4, max_depth=4).fit(vectors(spark, x, y, partitions=p)), new) for p in (1, 5))
    assert np.allclose(a, b)


def test_extra_trees_without_depth_grow_until_leaves_are_pure(spark, monkeypatch):
    x = 1000.0 ** np.arange(16)[:, None]  # a uniform threshold takes off about one value a level
    y = np.random.default_rng(4).permutation(16).astype(float)
    df = vectors(spark, x, y)
    whole = ExtraTrees(n_estimators=2).fit(df)
    assert np.allclose(predictions(whole, df), y)
    monkeypatch.setattr("fitmesh.models.extratrees._STATE_BYTES", 120)  # three open nodes at once
    parts = ExtraTrees(n_estimators=2, max_depth=5).fit(vectors(spark, np.arange(16.0)[:, None], y))
    monkeypatch.undo()
    same = ExtraTrees(n_estimators=2, max_depth=5).fit(vectors(spark, np.arange(16.0)[:, None], y))
    new = vectors(spark, np.arange(16.0)[:, None])
    assert np.allclose(predictions(parts, new), predictions(same, new))


def test_extra_trees_hand_small_nodes_over(spark, monkeypatch):
    monkeypatch.setattr("fitmesh.models.extratrees.HAND_OVER", 60)
    x, y = signal(500)
    new = vectors(spark, x[:50])
    a, b = (ExtraTrees(n_estimators=3).fit(vectors(spark, x, y, partitions=k)) for k in (2, 7))
    assert np.allclose(predictions(a, new), predictions(b, new)) and np.allclose(predictions(a, vectors(spark, x)), y)
    shallow = ExtraTrees(n_estimators=2, max_depth=9).fit(vectors(spark, x, y))
    depth = np.zeros(len(shallow.state["tree"]), int)
    roots = np.flatnonzero(np.r_[True, np.diff(shallow.state["tree"]) > 0])
    for root, end in zip(roots, [*roots[1:], len(depth)]):
        stack = [root]
        while stack:
            k = stack.pop()
            for child in (shallow.state["left"][k], shallow.state["right"][k]):
                if child >= 0:
                    depth[root + int(child)] = depth[k] + 1
                    stack.append(root + int(child))
    assert depth.max() == 9


def test_svr_ignores_a_gross_outlier(spark):
    x = np.linspace(-1, 1, 101)[:, None]
    y = 2 * x[:, 0] + 1
    y[50] = 500.0
    m = SVR(kernel="linear", C=100.0, epsilon=0.01, max_iter=40).fit(vectors(spark, x, y))
    assert abs(float(m.state["theta"][0]) - 2) < 0.05 and abs(float(m.state["bias"]) - 1) < 0.05
    with pytest.raises(ValueError):
        SVR(kernel="poly").fit(vectors(spark, x, y))


def test_draws_follow_the_weights_and_add_up(spark):
    rng = np.random.default_rng(4)
    w = np.where(np.arange(600) % 3 == 0, 5.0, rng.uniform(0.0, 1.0, 600))
    df = durable(spark.createDataFrame([(i, float(v)) for i, v in enumerate(w)], "id int, w double").repartition(7)).withColumn("p", F.spark_partition_id())
    totals = {r["p"]: r["t"] for r in df.groupBy("p").agg(F.sum("w").alias("t")).collect()}
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")  # partitions of several batches
    try:
        n = 60_000
        drawn = draw_rows(df, "w", "p", totals, n, [1, 2])
        first, again = ({r["id"]: r["_drawn"] for r in drawn.collect()} for _ in range(2))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    got = np.array([first.get(i, 0) for i in range(600)])
    assert first == again and got.sum() == n
    expect = n * w / w.sum()
    assert ((got - expect) ** 2 / expect).sum() < 600 + 5 * np.sqrt(2 * 600)  # chi-squared, 599 degrees of freedom


def test_adaboost_resamples_and_falls_back_to_weights(spark):
    x, y = signal(900)
    df = vectors(spark, x, y)
    drawn, weighted = (AdaBoost(n_estimators=4, resample=r).fit(df) for r in (True, False))
    assert drawn.votes != weighted.votes and min(drawn.score(df), weighted.score(df)) > 0.6


@pytest.mark.parametrize("solver,schedule", [("adam", "constant"), ("sgd", "invscaling")])
def test_mini_batches_equal_numpy_in_the_same_order(spark, solver, schedule):
    x, y = signal(230)
    df = vectors(spark, x, y)
    model = MLP(hidden_layer_sizes=[5], activation="tanh", solver=solver, learning_rate=schedule, learning_rate_init=0.01, batch_size=50,
                max_iter=3, alpha=0.1, seed=9).fit(df)
    rows = df.select("features", "label").orderBy(F.xxhash64(F.lit(9), "features", "label")).collect()
    a, b = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    a, b = (a - a.mean(0)) / a.std(0), (b - b.mean()) / b.std()
    rng = np.random.default_rng(9)
    w1, w2 = rng.uniform(-1, 1, (3, 5)) * np.sqrt(6 / 8), rng.uniform(-1, 1, (5, 1)) * np.sqrt(6 / 6)
    params = [w1, np.zeros(5), w2, np.zeros(1)]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    t = 0
    for epoch in range(3):
        order = np.random.default_rng([9, epoch, 0]).permutation(230)
        for at in range(0, 230, 50):
            i = order[at:at + 50]
            t += 1
            h = np.tanh(a[i] @ params[0] + params[1])
            e = (h @ params[2] + params[3])[:, 0] - b[i]
            back = e[:, None] * params[2][:, 0] * (1 - h ** 2)
            grads = [(a[i].T @ back + 0.1 * params[0]) / len(i), back.sum(0) / len(i),
                     (h.T @ e[:, None] + 0.1 * params[2]) / len(i), e.sum(keepdims=True) / len(i)]
            step = 0.01 / np.sqrt(t) if schedule == "invscaling" else 0.01
            for p, g, m, v in zip(params, grads, first, second):
                if solver == "adam":
                    m[:], v[:] = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                    p -= step * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
                else:
                    m[:] = 0.9 * m - step * g
                    p += 0.9 * m - step * g
    assert np.allclose(model.state["flat"], np.concatenate([p.ravel() for p in params]), atol=1e-8)


def test_mini_batches_on_several_tasks_are_averaged(spark, monkeypatch):
    from fitmesh.models import mlp

    monkeypatch.setattr(mlp, "_TASK_BATCHES", 4)
    x, y = signal(1600)
    df = vectors(spark, x, y)
    assert mlp.shuffled(df.select(F.col("features").alias("x"), F.col("label").alias("y")), 1600, 50, 1).rdd.getNumPartitions() == 4
    one, two = (MLP(hidden_layer_sizes=[20], batch_size=50, max_iter=15).fit(df) for _ in range(2))
    assert one.score(df) > 0.85 and abs(one.score(df) - two.score(df)) < 0.1


def test_mlp_loss_falls(spark):
    x, y = signal(300)
    losses = MLP(hidden_layer_sizes=[8], max_iter=15, solver="sgd").fit(vectors(spark, x, y)).state["losses"]
    assert losses[-1] < losses[0]


def test_weighted_score(spark):

    x, y = signal(200)
    df = vectors(spark, x, y).withColumn("w", F.col("id") % 5 + 1.0)
    model = OLS().fit(df)
    p, w = predictions(model, df), np.arange(200) % 5 + 1.0
    want = 1 - (w * (y - p) ** 2).sum() / (w * (y - np.average(y, weights=w)) ** 2).sum()
    assert abs(model.score(df, "w") - want) < 1e-9


def test_grouped_fits_equal_separate_fits(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(a), float(b), float(g * a - b + 100)) for g, a, b in zip(rng.integers(0, 4, 400), rng.normal(size=400), rng.normal(size=400))]
    df = spark.createDataFrame(rows, "g long, a double, b double, y double")
    fits = {r["g"]: r for r in fit_by_group(df, ["g"], ["a", "b"], "y").collect()}
    for g in range(4):
        assert np.allclose(fits[g]["coefficients"], [g, -1.0]) and abs(fits[g]["intercept"] - 100) < 1e-9
    scored = predict_by_group(df, fit_by_group(df, ["g"], ["a", "b"], "y"), ["g"], ["a", "b"])
    assert all(abs(r["prediction"] - r["y"]) < 1e-8 for r in scored.collect())


def test_user_stage_reloads_from_its_import_path(spark, tmp_path):
    df = vectors(spark, np.eye(4), [1.0, 2.0, 3.0, 6.0])
    model = UserRegressor(mean_partial, mean_finish, mean_predict).fit(df)
    model.save(str(tmp_path / "m"))
    assert set(predictions(UserModel.load(str(tmp_path / "m")), df)) == {3.0}


def test_linear_model_reloads(spark, tmp_path):
    df = vectors(spark, np.eye(4), [1.0, 2.0, 3.0, 6.0])
    model = OLS().fit(df)
    model.save(str(tmp_path / "m"))
    assert np.allclose(predictions(LinearModel.load(str(tmp_path / "m")), df), predictions(model, df))


def test_unknown_parameters_are_refused():
    with pytest.raises(Exception):
        Ridge(beta=1.0)
    with pytest.raises(TypeError):
        Ridge(alpha="strong")


def test_exact_trees_split_small_nodes_together(monkeypatch):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 9, 3000), rng.random(3000), np.where(rng.random(3000) < 0.1, np.nan, rng.integers(0, 3, 3000))]).astype(float)
    y, w = rng.integers(0, 50, 3000).astype(float), rng.integers(1, 4, 3000).astype(float)
    grow = lambda depth, least: cart.grow_exact(x, y, w, depth, least, 3, np.random.default_rng(1))
    leaves = lambda t: cart.FlatForest(np.zeros(len(t["value"])), *[t[c] for c in cart._PARTS]).mean(np.vstack([x, x + 0.3]))
    for depth, least in ((None, 2), (6, 10)):
        monkeypatch.setattr(cart, "_SMALL", 64)
        many = grow(depth, least)
        monkeypatch.setattr(cart, "_SMALL", 0)
        one = grow(depth, least)
        assert len(many["value"]) == len(one["value"])
        assert np.array_equal(leaves(many), leaves(one))


def test_fourier_features_are_cosines():
    from fitmesh.models import svr

    rng = np.random.default_rng(5)
    x, w, b = rng.normal(size=(1500, 3)) * 5, rng.normal(size=(3, 7)), rng.random(7) * 6
    assert svr._ROWS < 1500
    assert np.allclose(svr.fourier(x, w, b), np.sqrt(2 / 7) * np.cos(x @ w + b), rtol=0, atol=1e-13)
    assert svr.fourier(x[:0], w, b).shape == (0, 7)


def test_epochs_read_blocks_of_rows(spark):
    from fitmesh.models import mlp

    df = spark.range(0, 3000, numPartitions=3).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"), F.col("id").cast("double").alias("y"))
    data = mlp.shuffled(df, 3000, 10, 1)
    found = [(x.copy(), y.copy()) for x, y in mlp._unpacked(data.toArrow().to_batches())]
    assert data.count() == len(found) < 100
    assert sorted(np.concatenate([y for _, y in found])) == list(range(3000))
    assert all(np.array_equal(x, np.column_stack([y, np.ones(len(y))])) for x, y in found)
