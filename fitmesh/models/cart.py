"""Regression trees with exact splits and no depth limit.

Rows are written once, in blocks. Nodes with many rows are split from weighted sums per bin, for all trees in one pass a level over binned blocks. Rows, sum and
squares of a bin bound the gain of every cut inside it; bins that may hold a better cut than the best between bins send their distinct values, with
sums, to a task each. So the cut is the best of all, whatever the rows: bins only save work. A node with ``HAND_OVER`` rows or fewer that may be
split moves whole to one task, which finishes its subtree; so passes over the data grow with the logarithm of the rows, and a small table is one shuffle.
No task gets more than ``HAND_OVER`` rows of a node (16 times as many where levels go on for long because cuts take off a few rows only)
or the distinct values of a bin: leaves with more rows take their value from the sums.
The subtrees of a single tree with over ``MAX_NODES`` nodes stay a table, which predictions meet in a shuffle. Bootstrap weights, feature subsets and therefore trees depend
on seeds, row values and positions in the tree only where rows are handed over, never on the number of tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from fitmesh.functions.forest import FlatForest
from fitmesh.functions.vectors import as_array, list_column, map_rows, matrix, width
from fitmesh.models.base import RegressionModel, StateReader, StateWriter
from fitmesh.models.boosting import cut_points
from fitmesh.operators.packed import blocks, count_and_mean, pack_blocks, pack_rows, row_blocks, sums
from fitmesh.operators.partials import reduce_arrays
from fitmesh.session import durable, spread

HAND_OVER = 20_000  # rows of a node that one task finishes
_LATE = 16  # times as many where cuts take off a few rows only, which would take a pass each
MAX_NODES = 1 << 20  # of a tree that the driver and every task hold
_DEALT = 4 << 20  # rows that one shuffle deals to tasks
_SMALL = 64  # rows of nodes that are split many at a time
_PADDED = 1 << 20  # values of such nodes that are sorted at once
_STATE_BYTES = 64 << 20
_BINS = 256
_BIN_ROWS = 250_000  # a bin of more has further bins
_CORNERS = 16  # of the polygon that bounds what a bin's rows can add up to
_PARTS = ("feature", "threshold", "left", "right", "value")


class _Writer(StateWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if self.instance.subtrees is not None:
            self.instance.subtrees.write.parquet(f"{path}/subtrees")


class _Reader(StateReader):
    def load(self, path: str):
        model = super().load(path)
        if "apart" in model.state:
            model.subtrees = self.sparkSession.read.parquet(f"{path}/subtrees")
        return model


class TreesModel(RegressionModel):
    """The mean of the trees. ``subtrees`` (``tree, node`` and the parts as bytes) grow from leaves of a single large tree."""

    def __init__(self, state=None, subtrees: DataFrame | None = None, **values):
        super().__init__(state, **values)
        self.subtrees = subtrees

    def _transform(self, df: DataFrame) -> DataFrame:
        forest = FlatForest(*[np.atleast_1d(self.state[c]) for c in ("tree", *_PARTS)])
        x, out = as_array(df, self.getFeaturesCol()), self.getPredictionCol()
        if self.subtrees is None:
            return df.withColumn(out, map_rows(forest.mean, x))
        columns = [c for c in df.columns if c != out]
        rows = df.select(map_rows(lambda v: forest.leaves(v, 0).astype(float), x).cast("int").alias("_node"), x.alias("_x"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"))
        trees = self.subtrees.select(F.col("node").alias("_node"), *_PARTS)
        both = rows.unionByName(trees, allowMissingColumns=True).repartition("_node").sortWithinPartitions("_node", F.col("feature").isNull())
        value = forest.value

        def predict(batches):
            at = sub = None
            for b in batches:
                node = b.column("_node").to_numpy()
                for part in np.split(np.arange(len(node)), np.flatnonzero(np.diff(node)) + 1):
                    if not len(part):
                        continue
                    if node[part[0]] != at:
                        at, sub = node[part[0]], None
                    if b.column("feature")[int(part[0])].is_valid:  # its subtree comes first
                        parts = [np.frombuffer(b.column(c)[int(part[0])].as_buffer()) for c in _PARTS]
                        sub, part = FlatForest(np.zeros(len(parts[0])), *parts), part[1:]
                    if len(part):
                        own = b.slice(int(part[0]), len(part))
                        found = np.full(len(part), value[at]) if sub is None else sub.mean(matrix(own.column("_x")))
                        yield pa.RecordBatch.from_arrays([own.column("_row"), pa.array(found)], names=["_row", out])

        scored = both.mapInArrow(predict, StructType([rows.schema["_row"], StructField(out, DoubleType())]))
        return scored.select(*[F.col(f"_row.`{c}`").alias(c, metadata=df.schema[c].metadata) for c in columns], F.col(out))

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)


def _uniform(r: np.ndarray, salt: int) -> np.ndarray:
    x = (r ^ np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(29))) / 2.0**64


def bootstrap_weights(r: np.ndarray, tree: int) -> np.ndarray:
    """How often each row is drawn: Poisson with mean 1, the limit of drawing as many rows as there are with replacement."""
    cdf = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])
    return np.searchsorted(cdf, _uniform(r, tree), "right").astype(float)


def _subset(rng: np.random.Generator, p: int, wanted: int) -> np.ndarray:
    return np.arange(p) if wanted >= p else np.sort(rng.choice(p, wanted, replace=False))


def _segment_sums(v: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Rounded like ``sum`` of each segment, so that ties between cuts break the same way however many nodes are split at once."""
    out = np.zeros(len(first))
    few = count < 8
    for k in range(7):
        on = np.flatnonzero(few & (count > k))
        out[on] += v[first[on] + k]
    for i in np.flatnonzero(~few):
        out[i] = v[first[i] : first[i] + count[i]].sum()
    return out


def _grow_small(x: np.ndarray, y: np.ndarray, w: np.ndarray, start: list[tuple], out: dict[str, np.ndarray], depth: int | None, least: int) -> dict[str, np.ndarray]:
    """``grow_exact`` with all features below nodes (position, rows, level) of at most ``_SMALL`` rows: nodes of similar size are one padded array."""
    p = x.shape[1]
    grown = {c: [v] for c, v in out.items()}
    size = len(out["value"])
    at, level = np.array([s[0] for s in start]), np.array([s[2] for s in start])
    rows, count = np.concatenate([s[1] for s in start]), np.array([len(s[1]) for s in start])
    value = out["value"][at]
    base = 0  # position of the first node of the newest array
    while len(at):
        first = np.cumsum(count) - count
        able = (count >= max(least, 2)) & (np.minimum.reduceat(y[rows], first) != np.maximum.reduceat(y[rows], first))
        if depth is not None:
            able &= level < depth
        able = np.flatnonzero(able)
        kind = np.ceil(np.log2(count[able])).astype(int)
        made = []  # arrays of nodes that are split: node, feature, cut, rows of both children in turn, numbers of those
        for k in np.unique(kind):
            wide = 1 << int(k)
            own = able[kind == k]
            step = max(1, _PADDED // (wide * p))
            for some in (own[i : i + step] for i in range(0, len(own), step)):
                m = np.arange(len(some))
                real = np.arange(wide) < count[some, None]
                r = rows[np.where(real, first[some, None] + np.arange(wide), first[some, None])]
                values = np.where(real[:, :, None], x[r], np.nan)
                weight = np.where(real, w[r], 0.0)
                shifted = weight * (y[r] - value[some, None])
                order = np.argsort(values, axis=1, kind="stable")  # what pads a node stays last
                ranked = np.take_along_axis(values, order, 1)
                n, s = (np.cumsum(v[m[:, None, None], order], 1)[:, :-1] for v in (weight, shifted))
                with np.errstate(all="ignore"):
                    gain = np.where(ranked[:, 1:] > ranked[:, :-1], s * s / n + s * s / np.maximum(weight.sum(1)[:, None, None] - n, 1e-300), -np.inf)
                top = gain.max(axis=1)
                j = top.argmax(axis=1)
                k_ = gain.argmax(axis=1)[m, j]
                low, high = ranked[m, k_, j], ranked[m, k_ + 1, j]
                cut = (low + high) / 2
                cut = np.where((low <= cut) & (cut < high), cut, low)
                yes = np.flatnonzero(top[m, j] > 0)
                go = values[m, :, j][yes] <= cut[yes, None]
                side = (2 * np.arange(len(yes))[:, None] + ~go)[real[yes]]
                made.append((some[yes], j[yes], cut[yes], r[yes][real[yes]][np.argsort(side, kind="stable")], np.bincount(side, minlength=2 * len(yes))))
        node, j, cut, rows, numbers = (np.concatenate(v) for v in zip(*made)) if made else (np.array([], int),) * 5
        child = size + 2 * np.arange(len(node))
        # the nodes of this level are in the newest array, those of the first level anywhere in it
        for c, v in zip(_PARTS, (j, cut, child, child + 1)):
            grown[c][-1][at[node] - base] = v
        if not len(node):
            break
        level, count = np.repeat(level[node] + 1, 2), numbers
        begin = np.cumsum(count) - count
        value = _segment_sums(y[rows] * w[rows], begin, count) / _segment_sums(w[rows], begin, count)
        base, at = size, size + np.arange(len(count))
        size += len(count)
        for c, v in zip(_PARTS, (-1.0, 0.0, -1.0, -1.0)):
            grown[c].append(np.full(len(count), v))
        grown["value"].append(value)
    return {c: np.concatenate(v) for c, v in grown.items()}


def grow_exact(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int | None, least: int, wanted: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """A whole tree over some rows: best cut between neighbouring values, on midpoints, until nodes are pure or too small."""
    out = {c: [] for c in _PARTS}

    def node(rows: np.ndarray) -> int:
        for c, v in zip(_PARTS, (-1, 0.0, -1, -1, float(np.average(y[rows], weights=w[rows])))):
            out[c].append(v)
        return len(out["feature"]) - 1

    stack, small = [(node(np.arange(len(y))), np.arange(len(y)), 0)], []
    while stack:
        at, rows, level = stack.pop()
        if len(rows) <= _SMALL and wanted >= x.shape[1]:
            small.append((at, rows, level))
            continue
        own = y[rows]
        if len(rows) < max(least, 2) or (depth is not None and level >= depth) or own.min() == own.max():
            continue
        columns = _subset(rng, x.shape[1], wanted)
        part = x[np.ix_(rows, columns)]
        order = np.argsort(part, axis=0, kind="stable")
        values = np.take_along_axis(part, order, 0)
        weight, shifted = w[rows], own - out["value"][at]
        n, s = np.cumsum(weight[order], 0)[:-1], np.cumsum((weight * shifted)[order], 0)[:-1]
        gain = np.where(values[1:] > values[:-1], s * s / n + s * s / np.maximum(weight.sum() - n, 1e-300), -np.inf)  # the shifted sums of both sides cancel
        best = int(gain.argmax(axis=0)[(top := gain.max(axis=0)).argmax()]), int(top.argmax())
        if not gain[best] > 0:
            continue
        k, j = best
        low, high = values[k, j], values[k + 1, j]
        cut = (low + high) / 2
        cut = cut if low <= cut < high else low
        go = part[:, j] <= cut
        left, right = node(rows[go]), node(rows[~go])
        out["feature"][at], out["threshold"][at], out["left"][at], out["right"][at] = int(columns[j]), cut, left, right
        stack += [(left, rows[go], level + 1), (right, rows[~go], level + 1)]
    out = {c: np.asarray(v, float) for c, v in out.items()}
    return _grow_small(x, y, w, small, out, depth, least) if small else out


class _Top:
    """The part of a tree above what is handed over."""

    def __init__(self, n: float, mean: float):
        self.nodes = {c: [v] for c, v in zip(_PARTS, (-1, 0.0, -1, -1, mean))}
        self.n, self.handed = n, {}  # rows; position: rows, depth of the nodes handed over
        self.grafts: list[tuple[int, dict[str, np.ndarray]]] = []

    def split(self, at: int, feature: int, cut: float, values: tuple[float, float]) -> tuple[int, int]:
        size = len(self.nodes["feature"])
        for c, v in zip(_PARTS, (-1, 0.0, -1, -1)):
            self.nodes[c] += [v, v]
        self.nodes["value"] += values
        for c, v in zip(_PARTS, (feature, cut, size, size + 1)):
            self.nodes[c][at] = v
        return size, size + 1

    def whole(self) -> dict[str, np.ndarray]:
        """The tree with its finished subtrees: their roots in the places of the nodes, the rest at the end."""
        out, base = {c: [np.array(v, float)] for c, v in self.nodes.items()}, len(self.nodes["feature"]) - 1
        for at, sub in self.grafts:
            for c in _PARTS:
                v = sub[c] if c not in ("left", "right") else np.where(sub[c] > 0, sub[c] + base, -1)
                out[c][0][at] = v[0]
                out[c].append(v[1:])
            base += len(sub["feature"]) - 1
        return {c: np.concatenate(v) for c, v in out.items()}


def _flat(trees: list[_Top]) -> FlatForest:
    return FlatForest(np.repeat(np.arange(len(trees)), [len(t.nodes["feature"]) for t in trees]), *[np.concatenate([t.nodes[c] for t in trees]) for c in _PARTS])


def grow_trees(df: DataFrame, features: str, label: str, trees: int, depth: int | None, least: int, wanted: int | None, bootstrap: bool, seed: int) -> TreesModel:
    """``least``: rows a node needs to be split; ``wanted``: features tried at a node (None: all)."""
    p = width(df, features)
    wanted = p if wanted is None else wanted
    data = spread(df.select(as_array(df, features).alias("x"), F.col(label).cast("double").alias("y")))
    if bootstrap:
        data = data.withColumn("r", F.xxhash64("x", "y", F.monotonically_increasing_id()))
    data = durable(pack_rows(data, p, list(_kept(bootstrap))))
    n, mean = count_and_mean(data, "y")
    if not n:
        raise ValueError("empty input")
    grown = [_Top(float(n), mean) for _ in range(trees)]
    if n > HAND_OVER:
        cuts = cut_points(data, p, max(_BINS, min(n // _BIN_ROWS, 1 << 15)))
        _split_large(data, grown, cuts, mean, depth, least, wanted, bootstrap, seed)
    else:
        for t in grown:
            t.handed[0] = t.n, 0
    batch, dealt = [], 0.0
    subtrees = None
    for i, t in enumerate(grown):
        batch, dealt = [*batch, i], dealt + sum(rows for rows, _ in t.handed.values())
        if i == trees - 1 or dealt >= _DEALT:
            subtrees = _finish(data, grown, batch, p, depth, least, wanted, bootstrap, seed)
            batch, dealt = [], 0.0
    done = [t.whole() for t in grown]
    state = {c: np.concatenate([t[c] for t in done]) for c in _PARTS}
    state["tree"] = np.repeat(np.arange(len(done)), [len(t["feature"]) for t in done]).astype(float)
    return TreesModel(state) if subtrees is None else TreesModel({**state, "apart": 1.0}, subtrees)


def _kept(bootstrap: bool) -> dict[str, type]:
    """Columns of a row besides its features; ``r`` is what its weights depend on."""
    return {"y": np.float64, "r": np.uint64} if bootstrap else {"y": np.float64}


def _weights(n: int, r: tuple[np.ndarray, ...], tree: int, seed: int) -> np.ndarray:
    """Of ``n`` rows: drawn by the only array in ``r``, or 1 without one."""
    return bootstrap_weights(r[0], seed * 1_000_003 + tree) if r else np.ones(n)


def _gain(n: np.ndarray, s: np.ndarray, total: np.ndarray, sum_: np.ndarray) -> np.ndarray:
    """What a cut with ``n`` rows and the sum ``s`` on its left explains of a node."""
    with np.errstate(all="ignore"):
        d = s - n * (sum_ / total)  # the shifted sums of both sides cancel
        return np.where((n > 0) & (n < total), d * d / n + d * d / (total - n), -np.inf)


def _inside(n: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Upper bounds of the gain of cuts inside each bin of a node, from rows, sums and squares (features, bins).

    ``m`` rows of a bin have a sum within ``sqrt(m (n - m) / n * (q - s * s / n))`` of ``m`` times its mean: an ellipse. The gain is
    convex, so no point of it exceeds the corners of a polygon around it.
    """
    angle = np.pi * (2 * np.arange(_CORNERS)[:, None, None] + 1) / _CORNERS
    far = 1 / np.cos(np.pi / _CORNERS)
    total, sum_ = n[0].sum(), s[0].sum()
    with np.errstate(all="ignore"):
        mean = np.where(n > 0, s / n, 0.0)
        spread = np.sqrt(n * (np.maximum(q - s * mean, 0.0) + 1e-9 * q)) / 2
        m = np.clip(n / 2 * (1 + np.cos(angle) * far), 0.0, n)
        before_n, before_s = np.cumsum(n, axis=-1) - n, np.cumsum(s, axis=-1) - s
        at = _gain(before_n + m, before_s + m * mean + spread * np.sin(angle) * far, total, sum_)
    return np.where(np.isfinite(at), at, np.inf).max(axis=0) * (1 + 1e-9)


def _smallest(packed: DataFrame, size: int, of) -> np.ndarray:
    """The smallest of the values of each number: ``of`` yields both for the blocks of a task."""

    def fold(batches):
        acc = np.full(size, np.inf)
        for at, v in of(batches):
            np.minimum.at(acc, at, v)
        return {"s": acc}

    return reduce_arrays(packed, fold, "min").get("s", np.full(size, np.inf))


def _split_large(data, grown: list[_Top], cuts, mean: float, depth, least, wanted, bootstrap: bool, seed: int) -> None:
    """Splits nodes (tree, position, rows, depth) above ``HAND_OVER`` rows level by level; smaller ones are handed over."""
    p, bins = len(cuts), max(map(len, cuts)) + 1
    most = max(1, _STATE_BYTES // (3 * p * bins * 8))
    packed = durable(pack_blocks(data.where("y is not null"), cuts, ["x", *_kept(bootstrap)]))

    def rows_of(batches):
        for b, x, y, *r in blocks(p, {"x": np.float64, **_kept(bootstrap)})(batches):
            yield b, x.reshape(p, -1).T, y, *r

    def values(sign):
        def of(batches):
            for b, x, *_ in rows_of(batches):
                for j in range(p):
                    yield j * bins + b[:, j].astype(int), sign * x[:, j]

        return of

    lone = (_smallest(packed, p * bins, values(1)) == -_smallest(packed, p * bins, values(-1))).reshape(p, bins)  # bins of one value
    level, limit = [(i, 0, t.n, 0) for i, t in enumerate(grown)], HAND_OVER
    passes = 4 + 2 * math.log2(max(t.n for t in grown) / HAND_OVER)
    while level:
        passes, todo = passes - 1, []
        if passes < 0:
            limit = min(2 * limit, _LATE * HAND_OVER)
        for i, at, rows, d in level:
            if depth is not None and d >= depth or rows < least:
                continue  # a leaf; its value is set
            if rows <= limit:
                grown[i].handed[at] = rows, d
            else:
                todo.append((i, at, rows, d))
        level = []
        for first in range(0, len(todo), most):
            some = todo[first : first + most]
            forest = _flat(grown)
            slot = np.full(len(forest.feature), -1)
            for j, (i, at, *_) in enumerate(some):
                slot[forest.roots[i] + at] = j
            used = sorted({i for i, *_ in some})

            def placed(batches):
                """Rows of the nodes: bins, features, label, node, weight."""
                for b, x, y, *r in rows_of(batches):
                    for i in used:
                        s, w = slot[forest.leaves(x, forest.roots[i])], _weights(len(y), r, i, seed)
                        rows = np.flatnonzero((s >= 0) & (w > 0))
                        yield b[rows], x[rows], y[rows] - mean, s[rows], w[rows]

            def fold(batches):
                acc = np.zeros((3, len(some), p, bins))
                for b, _, y, s, w in placed(batches):
                    sums(b, s, len(some), bins, (w, w * y, w * y * y), acc)
                return {"s": acc.ravel()}

            n, s, q = reduce_arrays(packed, fold)["s"].reshape(3, len(some), p, bins)
            total, sum_, square = (v[:, 0].sum(axis=-1) for v in (n, s, q))
            even = square - sum_ * sum_ / total <= 1e-9 * square  # so little that the label may have one value
            if even.any():
                low, high = (_smallest(packed, len(some), lambda batches, sign=sign: ((s[even[s]], sign * y[even[s]]) for _, _, y, s, _ in placed(batches))) for sign in (1, -1))
                even &= low == -high
            tried = np.zeros((len(some), p), bool)
            for j, (i, at, *_) in enumerate(some):
                tried[j, _subset(np.random.default_rng([seed, i, at]), p, wanted)] = not even[j]
            gain = np.where(tried[:, :, None], _gain(np.cumsum(n, -1)[..., :-1], np.cumsum(s, -1)[..., :-1], total[:, None, None], sum_[:, None, None]), -np.inf)
            top = gain.max(axis=(1, 2), initial=-np.inf)
            open_ = np.stack([_inside(n[j], s[j], q[j]) > top[j] for j in range(len(some))]) & tried[:, :, None] & ~lone & (n > 0)
            best = {}  # node: gain, less feature and cut, rows and sum on the left
            for j in np.flatnonzero(np.isfinite(top)):
                f, c = np.unravel_index(int(gain[j].argmax()), gain[j].shape)
                best[int(j)] = float(top[j]), -int(f), -float(cuts[f][c]), float(n[j, f, : c + 1].sum()), float(s[j, f, : c + 1].sum())
            for j, *found in _inner_cuts(packed, placed, open_, n, s):
                best[j] = max(best.get(j, (-np.inf,)), tuple(found))
            for j, (i, at, rows, d) in enumerate(some):
                if j not in best or not best[j][0] > 1e-24 * square[j]:
                    continue  # a leaf: no cut explains anything
                _, f, cut, here, part = best[j]
                means = mean + part / here, mean + (float(sum_[j]) - part) / (float(total[j]) - here)
                left, right = grown[i].split(at, -f, -cut, means)
                level += [(i, left, here, d + 1), (i, right, float(total[j]) - here, d + 1)]
    _centre(packed, grown, rows_of, seed)


def _inner_cuts(packed: DataFrame, placed, open_: np.ndarray, n: np.ndarray, s: np.ndarray) -> Iterator[tuple]:
    """The best cut inside each bin of ``open_`` (node, feature, bin): node, gain, less feature and cut, rows and sum on the left."""
    node, feature, bin_ = np.nonzero(open_)
    if not len(node):
        return
    number = np.full(open_.shape, -1, np.int32)
    number[open_] = np.arange(len(node))
    before = np.stack([np.cumsum(v, -1)[open_] - v[open_] for v in (n, s)], 1)
    whole = np.stack([v[:, 0].sum(-1)[node] for v in (n, s)], 1)

    def deal(batches) -> Iterator[pa.RecordBatch]:
        for b, x, y, at, w in placed(batches):
            for f in range(x.shape[1]):
                own = number[at, f, b[:, f]]
                on = np.flatnonzero(own >= 0)
                if not len(on):
                    continue
                on = on[np.lexsort((x[on, f], own[on]))]
                own, v = own[on], x[on, f]
                start = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (v[1:] != v[:-1])])
                yield pa.RecordBatch.from_arrays([pa.array(own[start]), pa.array(v[start]), *[pa.array(np.add.reduceat(a, start)) for a in (w[on], (w * y)[on])]], names=["number", "v", "n", "s"])

    def best(table):
        k = table.column("number")[0].as_py()
        v, n, s = (table.column(c).to_numpy() for c in ("v", "n", "s"))
        order = np.argsort(v, kind="stable")
        v = v[order]
        n, s = before[k, 0] + np.cumsum(n[order]), before[k, 1] + np.cumsum(s[order])
        gain = np.where(v[1:] > v[:-1], _gain(n[:-1], s[:-1], *whole[k]), -np.inf)
        at = [int(gain.argmax())] if len(gain) and np.isfinite(gain.max()) else []
        return pa.table({"number": pa.array([k] * len(at), pa.int32()), **{c: pa.array(a[at], pa.float64()) for c, a in (("gain", gain), ("v", v), ("n", n), ("s", s))}})

    schema = "number int, v double, n double, s double"
    for r in packed.mapInArrow(deal, schema).groupBy("number").applyInArrow(best, "number int, gain double, v double, n double, s double").collect():  # a row a bin
        k = r["number"]
        yield int(node[k]), r["gain"], -int(feature[k]), -r["v"], r["n"], r["s"]


def _centre(packed: DataFrame, grown: list[_Top], rows_of, seed: int) -> None:
    """Moves the cuts to the middle between the values of their node on both sides, where ``grow_exact`` has them."""
    forest = _flat(grown)
    size = len(forest.feature)

    def sides(batches):
        for _, x, y, *r in rows_of(batches):
            for i, root in enumerate(forest.roots):
                live = np.flatnonzero(_weights(len(y), r, i, seed) > 0)
                here = np.full(len(live), root)
                while len(live := live[inner := forest.feature[here] >= 0]):
                    here = here[inner]
                    v = x[live, forest.feature[here]]
                    go = v <= forest.threshold[here]
                    yield here + size * ~go, np.where(go, -v, np.where(np.isnan(v), np.inf, v))
                    here = root + np.where(go, forest.left[here], forest.right[here])

    found = _smallest(packed, 2 * size, sides)
    low, high = -found[:size], found[size:]
    with np.errstate(invalid="ignore"):
        cut = (low + high) / 2
    cut = np.where(np.isfinite(cut) & (low <= cut) & (cut < high), cut, np.where(np.isfinite(low), low, forest.threshold))
    for t, root in zip(grown, forest.roots):
        t.nodes["threshold"] = [float(cut[root + k]) if f >= 0 else 0.0 for k, f in enumerate(t.nodes["feature"])]


def _finish(data: DataFrame, grown: list[_Top], batch: list[int], p: int, depth, least, wanted, bootstrap: bool, seed: int) -> DataFrame | None:
    """Grafts the subtrees of the nodes handed over, or returns them as a table when those of a single tree are too many."""
    part = [grown[i] for i in batch]
    if not any(t.handed for t in part):
        return None
    forest = _flat(part)
    handed = np.zeros(len(forest.feature), bool)
    for t, root in zip(part, forest.roots):
        handed[root + np.array(list(t.handed), int)] = True

    rows_of = row_blocks(p, _kept(bootstrap))

    def deal(batches) -> Iterator[pa.RecordBatch]:
        for x, y, *r in rows_of(batches):
            for i, root in zip(batch, forest.roots):
                w = _weights(len(y), r, i, seed)
                at = forest.leaves(x, root)
                keep = np.flatnonzero((w > 0) & handed[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keep), i), pa.int32()), pa.array(at[keep] - root, pa.int32()), pa.array(w[keep]), list_column(x[keep]), pa.array(y[keep])],
                    names=["tree", "node", "w", "x", "y"])

    levels = {i: {at: d for at, (_, d) in grown[i].handed.items()} for i in batch}

    def finish(key, table):
        i, at = (k.as_py() for k in key)
        x, y, w = matrix(table.column("x")), table.column("y").to_numpy(), table.column("w").to_numpy()
        left = None if depth is None else depth - levels[i][at]
        sub = grow_exact(x, y, w, left, least, wanted, np.random.default_rng([seed, i, at, 1]))
        return pa.table({"tree": pa.array([i], pa.int32()), "node": pa.array([at], pa.int32()), "size": pa.array([len(sub["value"])]),
                         **{c: pa.array([v.tobytes()], pa.binary()) for c, v in sub.items()}})

    schema = "tree int, node int, size long, " + ", ".join(f"{c} binary" for c in _PARTS)
    dealt = data.where("y is not null").mapInArrow(deal, "tree int, node int, w double, x array<double>, y double")
    finished = durable(dealt.groupBy("tree", "node").applyInArrow(finish, schema))  # by all tasks at once
    if len(grown) == 1 and finished.agg(F.sum("size")).first()[0] > MAX_NODES:
        return finished
    for r in finished.toLocalIterator():  # the model itself
        grown[r["tree"]].grafts.append((r["node"], {c: np.frombuffer(r[c]) for c in _PARTS}))
    return None
