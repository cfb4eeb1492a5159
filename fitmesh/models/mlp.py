"""Multi-layer perceptron trained by synchronous data-parallel gradient steps.

Mini-batches: an epoch is one pass. Every task starts from the shared weights, updates its copy after each mini-batch
of its rows, and the copies (with the optimiser's state) are averaged by rows at the end. Full batches (``batch_size=0``
and lbfgs): tasks sum gradients over their rows, the driver takes one step a pass. Inputs and label are standardised
inside the model.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.param import TypeConverters
from pyspark.ml.param.shared import HasSeed
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.vectors import as_array, map_rows, matrix
from fitmesh.models.base import RegressionModel, Regressor, param
from fitmesh.operators.partials import reduce_arrays
from fitmesh.operators.scale import mean_and_std
from fitmesh.session import durable, held

_ACT = {
    "relu": (lambda z: np.maximum(z, 0.0), lambda a: (a > 0).astype(float)),
    "tanh": (np.tanh, lambda a: 1.0 - a * a),
    "logistic": (lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60))), lambda a: a * (1.0 - a)),
    "identity": (lambda z: z, np.ones_like),
}


def _shapes(sizes: list[int]) -> list[tuple[int, int]]:
    return list(zip(sizes[:-1], sizes[1:]))


def _layers(flat: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in _shapes(sizes):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def forward(x: np.ndarray, flat: np.ndarray, sizes: list[int], activation: str) -> list[np.ndarray]:
    act, values = _ACT[activation][0], [x]
    layers = _layers(flat, sizes)
    for i, (w, b) in enumerate(layers):
        z = values[-1] @ w + b
        values.append(z if i == len(layers) - 1 else act(z))
    return values


def gradient(x: np.ndarray, y: np.ndarray, flat: np.ndarray, sizes: list[int], activation: str) -> tuple[float, np.ndarray]:
    """Summed half squared error and its gradient."""
    values = forward(x, flat, sizes, activation)
    layers = _layers(flat, sizes)
    delta = values[-1] - y[:, None]
    loss = 0.5 * float((delta ** 2).sum())
    grads: list[np.ndarray] = []
    for i in range(len(layers) - 1, -1, -1):
        grads = [np.concatenate([(values[i].T @ delta).ravel(), delta.sum(axis=0)]), *grads]
        if i:
            delta = (delta @ layers[i][0].T) * _ACT[activation][1](values[i])
    return loss, np.concatenate(grads)


class MLPModel(RegressionModel):
    activation = param("activation", "hidden activation", TypeConverters.toString)

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        sizes, flat, kind = [int(v) for v in s["sizes"]], s["flat"], self.get("activation")
        mean, scale = np.atleast_1d(s["mean"]), np.atleast_1d(s["scale"])
        y_mean, y_scale = float(s["y_mean"]), float(s["y_scale"])

        def predict(x):
            return forward((x - mean) / scale, flat, sizes, kind)[-1][:, 0] * y_scale + y_mean

        return df.withColumn(self.getPredictionCol(), map_rows(predict, as_array(df, self.getFeaturesCol())))


_TASK_BATCHES = 50  # mini-batches an epoch that make another task worth its averaging


class MLP(Regressor, HasSeed):
    """Rows are dealt to tasks and ordered by a hash once; each epoch shuffles them again within an Arrow batch.

    A task gets at least 50 mini-batches, so a small table is trained in sequence in one task.
    """

    hidden_layer_sizes = param("hidden_layer_sizes", "units per hidden layer", TypeConverters.toListInt)
    activation = param("activation", "relu, tanh, logistic or identity", TypeConverters.toString)
    solver = param("solver", "adam, sgd or lbfgs", TypeConverters.toString)
    alpha = param("alpha", "L2 penalty", TypeConverters.toFloat)
    learning_rate = param("learning_rate", "constant, invscaling or adaptive", TypeConverters.toString)
    learning_rate_init = param("learning_rate_init", "step size", TypeConverters.toFloat)
    max_iter = param("max_iter", "epochs, or steps where batches are full", TypeConverters.toInt)
    batch_size = param("batch_size", "rows of a mini-batch; 0: all rows (lbfgs always takes all)", TypeConverters.toInt)
    tol = param("tol", "relative gain that counts as progress", TypeConverters.toFloat)
    DEFAULTS = {"hidden_layer_sizes": [100], "activation": "relu", "solver": "adam", "alpha": 1e-4,
                "learning_rate": "constant", "learning_rate_init": 0.02, "max_iter": 100, "tol": 1e-5, "seed": 42,
                "batch_size": 200}

    def _fit(self, df: DataFrame) -> MLPModel:
        kind, solver, schedule = self.get("activation"), self.get("solver"), self.get("learning_rate")
        if kind not in _ACT or solver not in ("adam", "sgd", "lbfgs") or schedule not in ("constant", "invscaling", "adaptive"):
            raise ValueError("unknown activation, solver or learning_rate")
        n, mean, std = mean_and_std(df, self.getFeaturesCol())
        scale = np.where(std > 0, std, 1.0)
        label = F.col(self.getLabelCol()).cast("double")
        r = df.agg(F.avg(label).alias("m"), F.stddev_pop(label).alias("s")).first()
        y_mean, y_scale = float(r["m"]), float(r["s"]) or 1.0
        sizes = [len(mean), *self.get("hidden_layer_sizes"), 1]
        rng = np.random.default_rng(self.getSeed())
        gain = 2.0 if kind == "logistic" else 6.0
        flat = np.concatenate([np.concatenate([rng.uniform(-np.sqrt(gain / (a + b)), np.sqrt(gain / (a + b)), a * b), np.zeros(b)])
                               for a, b in _shapes(sizes)])
        mask = np.concatenate([np.concatenate([np.ones(a * b), np.zeros(b)]) for a, b in _shapes(sizes)])
        data = df.select(as_array(df, self.getFeaturesCol()).alias("x"), label.alias("y"))
        size, seed = self.get("batch_size"), self.getSeed()
        if solver != "lbfgs" and size > 0:
            flat, losses = _epochs(shuffled(data, n, size, seed), lambda x, y: ((x - mean) / scale, (y - y_mean) / y_scale), flat, mask,
                                   sizes, kind, solver, schedule, self.get("learning_rate_init"), self.get("alpha"), size,
                                   self.get("max_iter"), self.get("tol"), seed)
            return self._hand_over(MLPModel({"flat": flat, "sizes": sizes, "mean": mean, "scale": scale, "y_mean": y_mean,
                                             "y_scale": y_scale, "losses": losses}, activation=kind))
        data = held(data)

        def evaluate(weights):
            def fold(batches):
                acc = np.zeros(1 + len(weights))
                for b in batches:
                    x = matrix(b.column("x"))
                    if len(x):
                        y = (b.column("y").to_numpy(zero_copy_only=False) - y_mean) / y_scale
                        loss, grad = gradient((x - mean) / scale, y, weights, sizes, kind)
                        acc[0] += loss
                        acc[1:] += grad
                return {"g": acc}

            acc = reduce_arrays(data, fold)["g"] / n
            penalty = self.get("alpha") / n
            return acc[0] + 0.5 * penalty * float((mask * weights ** 2).sum()), acc[1:] + penalty * mask * weights

        try:
            if solver == "lbfgs":
                flat, losses = _lbfgs(evaluate, flat, self.get("max_iter"), self.get("tol"))
            else:
                flat, losses = _first_order(evaluate, flat, solver, schedule, self.get("learning_rate_init"),
                                            self.get("max_iter"), self.get("tol"))
        finally:
            data.unpersist()
        return self._hand_over(MLPModel({"flat": flat, "sizes": sizes, "mean": mean, "scale": scale, "y_mean": y_mean,
                                         "y_scale": y_scale, "losses": losses}, activation=kind))


def _packed(batches):
    """An Arrow batch of rows as one row of bytes: epochs read blocks, not rows."""
    for b in batches:
        x = matrix(b.column("x"))
        if len(x):
            y = b.column("y").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (np.ascontiguousarray(x), y)], names=["x", "y"])


def _unpacked(batches):
    for b in batches:
        for x, y in zip(b.column("x"), b.column("y")):
            y = np.frombuffer(y.as_buffer())
            yield np.frombuffer(x.as_buffer()).reshape(len(y), -1), y


def shuffled(data: DataFrame, n: float, size: int, seed: int) -> DataFrame:
    """Rows spread evenly over the training tasks, in the order of a seeded hash, as blocks; written once, so that every epoch sees the same."""
    spark = data.sparkSession
    parts = max(data.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    parts = int(max(1, min(parts, n // (size * _TASK_BATCHES))))
    return durable(data.repartition(parts).sortWithinPartitions(F.xxhash64(F.lit(seed), "x", "y"), "x", "y").mapInArrow(_packed, "x binary, y binary"))


def update(w, m, v, t, g, solver, rate):
    """One step from gradient ``g``: the weights and both moving averages after update number ``t``."""
    if solver == "adam":
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        return w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8), m, v
    m = 0.9 * m - rate * g
    return w + 0.9 * m - rate * g, m, v


def _epochs(data, standardise, w, mask, sizes, kind, solver, schedule, rate, alpha, size, max_iter, tol, seed):
    k = len(w)
    m, v, t, losses, best, stale = np.zeros(k), np.zeros(k), 0, [], np.inf, 0

    for epoch in range(max_iter):
        def run(batches, start=(w, m, v, t), epoch=epoch, rate=rate):
            from pyspark import TaskContext

            ctx = TaskContext.get()
            rng = np.random.default_rng([seed, epoch, ctx.partitionId() if ctx else 0])
            w, m, v, t = start
            rows, loss = 0, 0.0
            for x, y in _unpacked(batches):
                x, y = standardise(x, y)
                order = rng.permutation(len(x))
                for at in range(0, len(x), size):
                    some = order[at:at + size]
                    part, g = gradient(x[some], y[some], w, sizes, kind)
                    loss += part + 0.5 * alpha * float((mask * w * w).sum())
                    t += 1
                    w, m, v = update(w, m, v, t, (g + alpha * mask * w) / len(some), solver,
                                     rate / np.sqrt(t) if schedule == "invscaling" else rate)
                rows += len(x)
            return {"s": np.concatenate([[rows, loss, rows * t], rows * w, rows * m, rows * v])}

        s = reduce_arrays(data, run)["s"]
        s = s / s[0]
        w, m, v, t = s[3:3 + k], s[3 + k:3 + 2 * k], s[3 + 2 * k:], int(round(s[2]))
        losses.append(float(s[1]))
        stale = 0 if losses[-1] < best * (1.0 - tol) else stale + 1
        best = min(best, losses[-1])
        if stale >= 10:
            if schedule != "adaptive" or rate < 1e-6:
                break
            rate, stale = rate / 5.0, 0
    return w, losses


def _first_order(evaluate, w, solver, schedule, rate, max_iter, tol):
    m, v, losses, best, stale = np.zeros_like(w), np.zeros_like(w), [], np.inf, 0
    for t in range(1, max_iter + 1):
        loss, g = evaluate(w)
        losses.append(loss)
        stale = 0 if loss < best * (1.0 - tol) else stale + 1
        if loss < best:
            best, kept = loss, w.copy()
        if stale >= 10:
            if schedule != "adaptive" or rate < 1e-6:
                break
            rate, stale = rate / 5.0, 0
        step = rate / np.sqrt(t) if schedule == "invscaling" else rate
        w, m, v = update(w, m, v, t, g, solver, step)
    return kept, losses


def _lbfgs(evaluate, w, max_iter, tol, memory=10):
    loss, g = evaluate(w)
    losses, pairs = [loss], []
    for _ in range(max_iter):
        q, coef = g.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (y @ s)
            coef.append(a)
            q -= a * y
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(pairs, reversed(coef)):
            q += s * (a - (y @ q) / (y @ s))
        direction, slope, step = -q, -(g @ q), 1.0
        if slope >= 0:
            direction, slope, pairs = -g, -(g @ g), []
        new = None
        for _ in range(12):
            new = evaluate(w + step * direction)
            if new[0] <= loss + 1e-4 * step * slope:
                break
            step *= 0.5
        else:
            break
        s, y = step * direction, new[1] - g
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        w, done = w + s, loss - new[0] <= tol * max(abs(loss), 1e-12)
        loss, g = new
        losses.append(loss)
        if done:
            break
    return w, losses
