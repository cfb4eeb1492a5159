"""Extremely randomised trees, grown level by level for many trees at once.

A level takes two passes per batch of open nodes: value ranges of every node, then
counts and label sums left of one random threshold per (node, feature). Tasks emit
dense arrays per batch, so their size is bounded at any depth. A node with few rows
moves whole to one task, which finishes its subtree: passes grow with the logarithm
of the rows even where leaves are grown until they are pure.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasSeed
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.forest import FlatForest
from fitmesh.functions.vectors import as_array, list_column, map_rows, matrix, width
from fitmesh.models.base import RegressionModel, Regressor, param
from fitmesh.operators.partials import reduce_arrays
from fitmesh.session import held

_STATE_BYTES = 64 << 20    # dense statistics per task
HAND_OVER = 20_000         # rows of a node that one task finishes
_SHALLOW = 6               # levels left that passes over the data finish sooner
_PARTS = ("feature", "threshold", "left", "right", "value")


class ExtraTreesModel(RegressionModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        forest = FlatForest(*[self.state[c] for c in ("tree", "feature", "threshold", "left", "right", "value")])
        return df.withColumn(self.getPredictionCol(), map_rows(forest.mean, as_array(df, self.getFeaturesCol())))


class _Tree:
    def __init__(self, n: float, s: float, ss: float):
        self.feature, self.threshold, self.left, self.right, self.value = [-1], [0.0], [-1], [-1], [s / n]
        self.open, self.handed = [(0, n, s, ss)], {}

    def split(self, node: int, feature: int, threshold: float, sides) -> list[tuple[int, float, float, float]]:
        children = []
        for n, s, ss in sides:
            self.feature.append(-1)
            self.threshold.append(0.0)
            self.left.append(-1)
            self.right.append(-1)
            self.value.append(s / n)
            children.append((len(self.feature) - 1, n, s, ss))
        self.feature[node], self.threshold[node] = feature, threshold
        self.left[node], self.right[node] = children[0][0], children[1][0]
        return children


    def graft(self, node: int, sub: dict[str, list]) -> None:
        """Puts a finished subtree in the place of a node."""
        base = len(self.feature) - 1
        for c in _PARTS:
            own = getattr(self, c)
            moved = [v + base if v > 0 else -1 for v in sub[c]] if c in ("left", "right") else sub[c]
            own[node] = moved[0]
            own += moved[1:]


def grow_random(x: np.ndarray, y: np.ndarray, depth: int | None, rng: np.random.Generator) -> dict[str, list]:
    """A whole randomised tree over some rows."""
    out: dict[str, list] = {c: [] for c in _PARTS}

    def node(rows: np.ndarray) -> int:
        for c, v in zip(_PARTS, (-1.0, 0.0, -1.0, -1.0, float(y[rows].mean()))):
            out[c].append(v)
        return len(out["feature"]) - 1

    stack = [(node(np.arange(len(y))), np.arange(len(y)), 0)]
    while stack:
        at, rows, level = stack.pop()
        own, part = y[rows], x[rows]
        if len(rows) < 2 or (depth is not None and level >= depth) or own.min() == own.max():
            continue
        low, high = part.min(axis=0), part.max(axis=0)
        cut = low + rng.random(x.shape[1]) * (high - low)
        cut = np.where(cut < high, cut, low)  # rounding must not put all rows on one side
        go = part <= cut
        n, s = go.sum(axis=0), (go * (own - out["value"][at])[:, None]).sum(axis=0)
        gain = np.where(high > low, s * s / np.maximum(n, 1) + s * s / np.maximum(len(rows) - n, 1), -1.0)
        f = int(gain.argmax())
        if gain[f] < 0:
            continue
        left, right = node(rows[go[:, f]]), node(rows[~go[:, f]])
        out["feature"][at], out["threshold"][at], out["left"][at], out["right"][at] = float(f), float(cut[f]), float(left), float(right)
        stack += [(left, rows[go[:, f]], level + 1), (right, rows[~go[:, f]], level + 1)]
    return out


def _flatten(trees: list[_Tree]) -> dict[str, np.ndarray]:
    out = {c: np.concatenate([np.asarray(getattr(t, c), float) for t in trees])
           for c in ("feature", "threshold", "left", "right", "value")}
    out["tree"] = np.concatenate([np.full(len(t.feature), i, float) for i, t in enumerate(trees)])
    return out


def _slots(trees: list[_Tree], part: list[tuple[int, tuple]]) -> tuple[FlatForest, np.ndarray]:
    """The forest so far and, per array position, the index in ``part`` of the open node there (or -1)."""
    flat = _flatten(trees)
    forest = FlatForest(*[flat[c] for c in ("tree", "feature", "threshold", "left", "right", "value")])
    slot = np.full(len(flat["tree"]), -1)
    for n, (i, (node, *_)) in enumerate(part):
        slot[forest.roots[i] + node] = n
    return forest, slot


class ExtraTrees(Regressor, HasSeed):
    """No bootstrap; each open node draws one uniform threshold per feature and keeps the best."""

    n_estimators = param("n_estimators", "trees", TypeConverters.toInt)
    max_depth = param("max_depth", "None: until every leaf is pure")
    DEFAULTS = {"n_estimators": 100, "max_depth": None, "seed": 42}

    def _fit(self, df: DataFrame) -> ExtraTreesModel:
        depth = None if self.get("max_depth") is None else int(self.get("max_depth"))
        p = width(df, self.getFeaturesCol())
        data = df.select(as_array(df, self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        data = held(data)
        try:
            r = data.agg(F.count("y").alias("n"), F.avg("y").alias("m"), F.var_pop("y").alias("v")).first()
            if not r["n"]:
                raise ValueError("empty input")
            widest = max(1, int(r["n"]) // 2)  # open nodes have two rows at least
            if depth is None or depth > _SHALLOW:
                widest = max(1, int(r["n"]) // HAND_OVER, 2**_SHALLOW)
            elif depth - 1 < widest.bit_length():
                widest = min(widest, 2 ** max(depth - 1, 0))
            batch = max(1, min(self.get("n_estimators"), _STATE_BYTES // (widest * p * 5 * 8)))
            if depth is None or depth > _SHALLOW:
                batch = max(1, min(batch, (4 << 20) // int(r["n"])))  # rows times trees that one shuffle carries, a tree at least
            trees: list[_Tree] = []
            for start in range(0, self.get("n_estimators"), batch):
                count = min(batch, self.get("n_estimators") - start)
                trees += self._grow(data, p, depth, count, start, float(r["n"]), float(r["m"]), float(r["v"]))
        finally:
            data.unpersist()
        flat = _flatten(trees)
        flat["value"] = flat["value"] + float(r["m"])
        return self._hand_over(ExtraTreesModel(flat))

    def _grow(self, data: DataFrame, p: int, depth: int | None, count: int, first: int, n: float, mean: float, var: float) -> list[_Tree]:
        trees = [_Tree(n, 0.0, n * var) for _ in range(count)]
        rngs = [np.random.default_rng([self.getSeed(), first + i]) for i in range(count)]
        most = max(1, _STATE_BYTES // (p * 5 * 8))
        for level in itertools.count() if depth is None else range(depth):
            todo = [(i, o) for i, t in enumerate(trees) for o in t.open
                    if o[1] >= 2 and o[3] - o[2] ** 2 / o[1] > 1e-12 * max(n * var, 1e-300) / n]
            if depth is None or depth - level > _SHALLOW:
                for i, o in todo:
                    if o[1] <= HAND_OVER:
                        trees[i].handed[o[0]] = level
                todo = [(i, o) for i, o in todo if o[1] > HAND_OVER]
            for t in trees:
                t.open = []
            if not todo:
                break
            for at in range(0, len(todo), most):
                self._split(data, p, trees, rngs, todo[at:at + most], mean)
        if any(t.handed for t in trees):
            self._finish(data, trees, depth, first, mean)
        return trees

    def _finish(self, data: DataFrame, trees: list[_Tree], depth: int | None, first: int, mean: float) -> None:
        """Grows the handed-over nodes of all trees, one task each."""
        flat, handed, seed = _flatten(trees), [t.handed for t in trees], self.getSeed()
        forest = FlatForest(*[flat[c] for c in ("tree", *_PARTS)])

        def deal(batches):
            for b in batches:
                x = matrix(b.column("x"))
                for i, root in enumerate(forest.roots):
                    at = forest.leaves(x, root) - root
                    keep = np.flatnonzero(np.isin(at, list(handed[i])))
                    if len(keep):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(keep), i), pa.int32()), pa.array(at[keep], pa.int32()), list_column(x[keep]), b.column("y").take(pa.array(keep))],
                            names=["tree", "node", "x", "y"])

        def finish(key, table):
            i, at = (k.as_py() for k in key)
            left = None if depth is None else depth - handed[i][at]
            x, y = matrix(table.column("x")), table.column("y").to_numpy() - mean
            order = np.lexsort((y, *x.T[::-1]))  # sums do not depend on the order in which rows arrive
            sub = grow_random(x[order], y[order], left, np.random.default_rng([seed, first + i, at]))
            return pa.table({"tree": pa.array([i], pa.int32()), "node": pa.array([at], pa.int32()), **{c: pa.array([v], pa.list_(pa.float64())) for c, v in sub.items()}})

        schema = "tree int, node int, " + ", ".join(f"{c} array<double>" for c in _PARTS)
        dealt = data.mapInArrow(deal, "tree int, node int, x array<double>, y double")
        found = dealt.groupBy("tree", "node").applyInArrow(finish, schema)
        for r in sorted(found.collect(), key=lambda r: (r["tree"], r["node"])):  # the model itself
            trees[r["tree"]].graft(r["node"], {c: list(r[c]) for c in _PARTS})

    def _split(self, data: DataFrame, p: int, trees: list[_Tree], rngs: list, part: list[tuple[int, tuple]], mean: float) -> None:
        """Splits the open nodes of one batch; their children are open in the next level."""
        forest, slot = _slots(trees, part)
        size, roots = len(part), forest.roots[sorted({i for i, _ in part})]

        def ranges(batches):
            low, high = np.full((size, p), np.inf), np.full((size, p), np.inf)
            for b in batches:
                x = matrix(b.column("x"))
                for root in roots:
                    s = slot[forest.leaves(x, root)]
                    rows = np.flatnonzero(s >= 0)
                    if len(rows):
                        order = rows[np.argsort(s[rows], kind="stable")]
                        starts = np.flatnonzero(np.r_[True, np.diff(s[order]) > 0])
                        at = s[order][starts]
                        low[at] = np.minimum(low[at], np.minimum.reduceat(x[order], starts, axis=0))
                        high[at] = np.minimum(high[at], np.minimum.reduceat(-x[order], starts, axis=0))
            return {"r": np.concatenate([low.ravel(), high.ravel()])}

        r = reduce_arrays(data.select("x"), ranges, "min")["r"].reshape(2, size, p)
        low, high = r[0], -r[1]
        cut = np.empty((size, p))
        for i, group in itertools.groupby(range(size), lambda k: part[k][0]):
            k = list(group)
            cut[k] = low[k] + rngs[i].random((len(k), p)) * (high[k] - low[k])
        cut = np.where(cut < high, cut, low)  # rounding must not put all rows on one side

        def sides(batches):
            acc = np.zeros((3, size, p))
            for b in batches:
                x = matrix(b.column("x"))
                y = b.column("y").to_numpy(zero_copy_only=False) - mean
                for root in roots:
                    s = slot[forest.leaves(x, root)]
                    rows = np.flatnonzero(s >= 0)
                    if not len(rows):
                        continue
                    go = x[rows] <= cut[s[rows]]
                    for f in range(p):
                        left = rows[go[:, f]]
                        where, yl = s[left], y[left]
                        acc[0, :, f] += np.bincount(where, minlength=size)
                        acc[1, :, f] += np.bincount(where, yl, minlength=size)
                        acc[2, :, f] += np.bincount(where, yl * yl, minlength=size)
            return {"s": acc.ravel()}

        left = reduce_arrays(data, sides)["s"].reshape(3, size, p)
        for at, (i, (node, nn, s, ss)) in enumerate(part):
            nl, sl, ssl = left[:, at]
            ok = (nl > 0) & (nl < nn) & (high[at] > low[at])
            gain = np.where(ok, sl ** 2 / np.maximum(nl, 1) + (s - sl) ** 2 / np.maximum(nn - nl, 1), -np.inf)
            f = int(gain.argmax())
            if ok[f]:
                trees[i].open += trees[i].split(node, f, float(cut[at, f]),
                                                [(nl[f], sl[f], ssl[f]), (nn - nl[f], s - sl[f], ss - ssl[f])])
