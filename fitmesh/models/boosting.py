"""Second-order gradient boosting on binned features: level-wise and leaf-wise growth.

Features are binned once by exact quantiles. A pass over the rows sums gradients and rows per (open node, feature, bin) in each
task; the driver sees one merged array and chooses splits by the penalised second-order gain. Of two children only the
smaller one is summed, the other is the rest of its parent. Leaf-wise growth opens the leaf with the largest gain first; a pass
sums the children of all leaves that may be next, so passes grow with the depth of a tree and not with its leaves.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasSeed
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.forest import FlatForest
from fitmesh.functions.vectors import as_array, map_rows, width
from fitmesh.models.base import RegressionModel, Regressor, param
from fitmesh.operators.orderstats import block_order_statistics
from fitmesh.operators.packed import blocks, count_and_mean, pack_blocks, pack_rows, sums
from fitmesh.operators.partials import reduce_arrays
from fitmesh.session import durable, spread

_STATE_BYTES = 64 << 20  # sums of open nodes in one task
_ROW = {"y": np.float64, "m": np.float64, "r": np.uint64}
_PENDING = 8  # trees evaluated on the fly before predictions are written


class BoostedModel(RegressionModel):
    """``base`` plus ``rate`` times the sum of the trees."""

    def _transform(self, df: DataFrame) -> DataFrame:
        base, rate = float(self.state["base"]), float(self.state["rate"])
        if not len(np.atleast_1d(self.state["tree"])):
            return df.withColumn(self.getPredictionCol(), F.lit(base))
        forest = FlatForest(*[self.state[c] for c in ("tree", "feature", "threshold", "left", "right", "value")])
        step = rate * len(forest.roots)
        return df.withColumn(self.getPredictionCol(), map_rows(lambda x: base + step * forest.mean(x), as_array(df, self.getFeaturesCol())))


@dataclass(eq=False)
class _Node:
    sums: np.ndarray  # (2, features, bins): gradients, rows
    depth: int
    split: tuple | None = None  # gain, feature, bin
    at: int = 0  # position in the tree
    children: list = field(default_factory=list)


class _Growing:
    """A tree as flat lists; thresholds are bins while it grows."""

    def __init__(self):
        self.feature, self.threshold, self.left, self.right, self.value = [-1], [0.0], [-1], [-1], [0.0]

    def open(self, at: int, feature: int, cut: int) -> tuple[int, int]:
        for c, v in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            c += [v, v]
        self.feature[at], self.threshold[at] = feature, float(cut)
        self.left[at], self.right[at] = len(self.feature) - 2, len(self.feature) - 1
        return self.left[at], self.right[at]

    def forest(self) -> FlatForest:
        return FlatForest(np.zeros(len(self.feature)), self.feature, self.threshold, self.left, self.right, self.value)


def cut_points(rows: DataFrame, p: int, bins: int) -> list[np.ndarray]:
    """At most ``bins - 1`` values of each feature of a table of ``pack_rows``; rows at or below a cut go left.

    Values that hold a thousandth of the rows are all cuts when they are few.
    """
    out = []
    for at in range(0, p, 256):
        part = range(at, min(p, at + 256))

        def positions(_, n):
            return np.unique(np.linspace(0, n - 1, bins * 4).astype(np.int64))  # finer than needed: repeated values drop out

        _, found = block_order_statistics(rows, p, part, positions)
        for j in part:
            values = np.unique(list(found[j].values()))
            if len(values) > bins:
                values = np.unique(values[np.linspace(0, len(values) - 1, bins).astype(int)])
            out.append(values[:-1])
    return out


class _Boosting:
    def __init__(self, data: DataFrame, cuts: list[np.ndarray], rate: float, penalty: float, least: float, gamma: float, share: float, seed: int):
        self.data, self.cuts, self.rate, self.penalty, self.least, self.gamma, self.share, self.seed = data, cuts, rate, penalty, least, gamma, share, seed
        self.p, self.bins = len(cuts), max(map(len, cuts), default=0) + 1
        self.most = max(1, _STATE_BYTES // max(1, 2 * self.p * self.bins * 8))
        self.pending: list[_Growing] = []

    def _sums(self, tree: _Growing, nodes: list[tuple[int, int, int, int]], round_: int) -> np.ndarray:
        """Sums of the rows that stand in node ``at`` of the tree and go left (side 0) or right (side 1) at a cut, for each
        of ``nodes`` = (at, feature, cut, side); feature -1 takes all rows of the node."""
        p, bins, share, seed, rows_of = self.p, self.bins, self.share, self.seed, blocks(self.p, _ROW)
        pending = [(t.forest(), self.rate) for t in self.pending]
        forest, size = tree.forest(), len(nodes)
        slot = np.full(len(tree.feature), -1)
        for k, (at, *_) in enumerate(nodes):
            slot[at] = k
        feature, cut, side = (np.array([n[j] for n in nodes]) for j in (1, 2, 3))

        def fold(batches):
            acc = np.zeros((2, size, p, bins))
            for x, y, m, r in rows_of(batches):
                g = m - y
                for f, rate in pending:
                    g = g + rate * f.value[f.leaves(x, 0)]
                s = slot[forest.leaves(x, 0)]
                rows = np.flatnonzero(s >= 0)
                if share < 1.0:
                    r = r[rows]
                    r = (r ^ np.uint64((0x9E3779B97F4A7C15 * (round_ + 1 + seed)) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
                    r = (r ^ (r >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
                    rows = rows[(r >> np.uint64(11)) < np.uint64(share * 2**53)]
                n = s[rows]
                if p:
                    goes = (feature[n] < 0) | ((x[rows, np.maximum(feature[n], 0)] > cut[n]) == side[n])
                    rows, n = rows[goes], n[goes]
                sums(x[rows], n, size, bins, (g[rows], None), acc)
            return {"s": acc.ravel()}

        return reduce_arrays(self.data, fold)["s"].reshape(2, size, p, bins)

    def _best(self, sums: np.ndarray) -> tuple | None:
        """Gain, feature and bin of the best split of a node."""
        g, h = np.cumsum(sums, axis=-1)[..., :-1]
        if not g.size:
            return None
        total_g, total_h = sums[0, 0].sum(), sums[1, 0].sum()
        ok = (h >= max(self.least, 1e-12)) & (total_h - h >= max(self.least, 1e-12))
        score = lambda a, b: a * a / np.maximum(b + self.penalty, 1e-300)
        gain = np.where(ok, 0.5 * (score(g, h) + score(total_g - g, total_h - h) - score(total_g, total_h)) - self.gamma, -np.inf)
        f, c = np.unravel_index(int(gain.argmax()), gain.shape)
        return (float(gain[f, c]), int(f), int(c)) if gain[f, c] > 1e-12 else None

    def _children(self, tree: _Growing, nodes: list[_Node], round_: int) -> None:
        """Sums of both children of every node, from those of the smaller one."""
        for at in range(0, len(nodes), self.most):
            part = nodes[at : at + self.most]
            asked = []
            for n in part:
                _, f, c = n.split
                left = n.sums[1, f, : c + 1].sum()
                asked.append((n.at, f, c, int(left > n.sums[1, f].sum() - left)))
            found = self._sums(tree, asked, round_)
            for k, (n, (_, _, _, side)) in enumerate(zip(part, asked)):
                small = _Node(found[:, k], n.depth + 1)
                other = _Node(n.sums - found[:, k], n.depth + 1)
                n.children = [small, other] if side == 0 else [other, small]
                for child in n.children:
                    child.split = self._best(child.sums)
                n.sums = n.sums[:, :1].sum(axis=-1, keepdims=True)  # only the totals are needed now

    def tree(self, round_: int, leaves: int | None, depth: int) -> _Growing:
        tree = _Growing()
        root = _Node(self._sums(tree, [(0, -1, 0, 0)], round_)[:, 0], 0)
        root.split = self._best(root.sums) if self.p else None
        able = lambda n: n.split is not None and (depth <= 0 or n.depth < depth)
        final, queue, count = [], [], 0

        def offer(n: _Node) -> None:
            nonlocal count
            final.append(n)
            if able(n):
                count += 1
                heapq.heappush(queue, (-n.split[0] if leaves else n.depth, count, n))

        offer(root)
        while queue and (leaves is None or len(final) < leaves):
            node = queue[0][2]
            if not node.children:
                room = len(queue) if leaves is None else leaves - len(final)
                self._children(tree, [n for _, _, n in heapq.nsmallest(room, queue) if not n.children], round_)
            heapq.heappop(queue)
            final.remove(node)
            _, f, c = node.split
            for child, at in zip(node.children, tree.open(node.at, f, c)):
                child.at = at
                offer(child)
        for n in final:
            g, h = n.sums[0, 0].sum(), n.sums[1, 0].sum()
            tree.value[n.at] = -g / max(h + self.penalty, 1e-300)
        return tree

    def add(self, tree: _Growing) -> None:
        self.pending.append(tree)
        if len(self.pending) < _PENDING:
            return
        pending, rate, p = [t.forest() for t in self.pending], self.rate, self.p

        def moved(batches):
            for b in batches:
                moved = []
                for x, _, m, _ in blocks(p, _ROW)([b]):
                    for f in pending:
                        m = m + rate * f.value[f.leaves(x, 0)]
                    moved.append(m.tobytes())
                yield b.set_column(b.schema.get_field_index("m"), "m", pa.array(moved, pa.binary()))

        self.data, self.pending = durable(self.data.mapInArrow(moved, self.data.schema)), []


class _Booster(Regressor, HasSeed):
    max_bin = param("max_bin", "bins of a feature", TypeConverters.toInt)

    def _plan(self) -> dict:
        raise NotImplementedError

    def _fit(self, df: DataFrame) -> BoostedModel:
        plan = self._plan()
        source = spread(df.select(as_array(df, self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y")))
        p = width(df, self.getFeaturesCol())
        source = durable(pack_rows(source.withColumn("r", F.xxhash64("x", "y", F.monotonically_increasing_id())), p, ["y", "r"]))  # read for the start, the cuts and the bins
        n, base = count_and_mean(source, "y")
        if not n:
            raise ValueError("empty input")
        cuts = cut_points(source, p, self.get("max_bin"))

        work = _Boosting(durable(pack_blocks(source, cuts, ["y", "r"], {"m": base})), cuts, plan["rate"], plan["penalty"], plan["least"], plan["gamma"], plan["share"],
                         self.getSeed())
        trees = []
        for k in range(plan["rounds"]):
            tree = work.tree(k, plan["leaves"], plan["depth"])
            trees.append(tree)
            work.add(tree)
        state = {c: np.array([v for t in trees for v in getattr(t, c)], float) for c in ("feature", "left", "right", "value")}
        state["threshold"] = np.array([cuts[f][int(c)] if f >= 0 else 0.0 for t in trees for f, c in zip(t.feature, t.threshold)], float)
        state["tree"] = np.array([i for i, t in enumerate(trees) for _ in t.feature], float)
        return self._hand_over(BoostedModel({**state, "base": base, "rate": plan["rate"]}))


class XGBoost(_Booster):
    """Level-wise second-order boosting under that library's parameter names and defaults (squared error, histograms).

    Gain ``(GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l))/2 - gamma``, leaf ``-G/(H+l)`` with ``l = reg_lambda``; starts from the mean.
    """

    n_estimators = param("n_estimators", "boosting rounds", TypeConverters.toInt)
    learning_rate = param("learning_rate", "shrinkage", TypeConverters.toFloat)
    max_depth = param("max_depth", "tree depth, 0: no limit", TypeConverters.toInt)
    subsample = param("subsample", "share of rows per round", TypeConverters.toFloat)
    reg_lambda = param("reg_lambda", "penalty on leaf values", TypeConverters.toFloat)
    gamma = param("gamma", "gain that a split must exceed", TypeConverters.toFloat)
    min_child_weight = param("min_child_weight", "Hessian (rows, for squared error) of a child", TypeConverters.toFloat)
    DEFAULTS = {"n_estimators": 100, "learning_rate": 0.3, "max_depth": 6, "subsample": 1.0, "reg_lambda": 1.0, "gamma": 0.0,
                "min_child_weight": 1.0, "max_bin": 256, "seed": 42}

    def _plan(self) -> dict:
        return {"rounds": self.get("n_estimators"), "rate": self.get("learning_rate"), "penalty": self.get("reg_lambda"), "gamma": self.get("gamma"),
                "least": self.get("min_child_weight"), "share": self.get("subsample"), "leaves": None, "depth": self.get("max_depth")}


class LightGBM(_Booster):
    """Leaf-wise second-order boosting under that library's parameter names and defaults (squared error)."""

    n_estimators = param("n_estimators", "boosting rounds", TypeConverters.toInt)
    learning_rate = param("learning_rate", "shrinkage", TypeConverters.toFloat)
    num_leaves = param("num_leaves", "leaves per tree", TypeConverters.toInt)
    max_depth = param("max_depth", "-1: no further limit", TypeConverters.toInt)
    reg_lambda = param("reg_lambda", "penalty on leaf values", TypeConverters.toFloat)
    min_child_samples = param("min_child_samples", "rows of a child", TypeConverters.toInt)
    DEFAULTS = {"n_estimators": 100, "learning_rate": 0.1, "num_leaves": 31, "max_depth": -1, "reg_lambda": 0.0, "min_child_samples": 20,
                "max_bin": 255, "seed": 42}

    def _plan(self) -> dict:
        return {"rounds": self.get("n_estimators"), "rate": self.get("learning_rate"), "penalty": self.get("reg_lambda"), "gamma": 0.0,
                "least": float(self.get("min_child_samples")), "share": 1.0, "leaves": self.get("num_leaves"), "depth": self.get("max_depth")}
