"""Small hand-made frames."""

import numpy as np


def vectors(spark, x, y=None, ids=None, partitions=4):
    ids = range(len(x)) if ids is None else ids
    y = np.zeros(len(x)) if y is None else y
    rows = [(i, [float(v) for v in r], float(t)) for i, r, t in zip(ids, x, y)]
    kind = "string" if rows and isinstance(rows[0][0], str) else "long"
    return spark.createDataFrame(rows, f"id {kind}, features array<double>, label double").repartition(partitions)


def signal(n=2000, seed=0):
    """Nonlinear label with noise variance 0.01."""
    rng = np.random.default_rng(seed)
    x = rng.uniform(-2, 2, (n, 3))
    y = np.sin(x[:, 0]) * 2 + x[:, 1] ** 2 + 0.5 * x[:, 2] + rng.normal(0, 0.1, n)
    return x, y


def r2(y, p):
    return 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
