"""Sufficient statistics: counts, sums and cross products, per group, in one pass.

Everything least-squares shaped (OLS, ridge, lasso, elastic net, PCA, stacking,
grouped fits, repeated cross-validation) is solved from these.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitmesh.functions.vectors import as_array, matrix, width
from fitmesh.operators.partials import MAX_STATE_BYTES, reduce_arrays

SQL_WIDTH = 11       # at most 100 aggregates, the limit of whole-stage codegen
MAX_WIDTH = 8192     # a dense cross-product matrix beyond this does not fit a driver


@dataclass
class Moments:
    """Additive moments of ``z = (x, y) - shift``: row count, sums, cross products."""

    n: float
    sums: np.ndarray
    cross: np.ndarray
    shift: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        return Moments(self.n + other.n, self.sums + other.sums, self.cross + other.cross, self.shift)

    def __sub__(self, other: "Moments") -> "Moments":
        return Moments(self.n - other.n, self.sums - other.sums, self.cross - other.cross, self.shift)

    @property
    def mean(self) -> np.ndarray:
        return self.shift + self.sums / self.n

    @property
    def scatter(self) -> np.ndarray:
        """Centred cross products, sum of (z - mean)(z - mean)^T."""
        return self.cross - np.outer(self.sums, self.sums) / self.n

    @classmethod
    def zero(cls, shift: np.ndarray) -> "Moments":
        d = len(shift)
        return cls(0.0, np.zeros(d), np.zeros((d, d)), shift)


def sufficient_stats(df: DataFrame, x: Sequence[Column | str], y: Column | str, by: Sequence[str] = (),
                     shift: Sequence[float] | None = None) -> DataFrame:
    """Per group: ``n, sum_x, sum_y, xtx, xty, yty`` as a DataFrame (``xtx`` is the upper triangle, row by row).

    Plain sums with map-side combine: a hot group shuffles one row per task.
    """
    shift = [0.0] * (len(x) + 1) if shift is None else [float(v) for v in shift]
    z = [(F.col(c) if isinstance(c, str) else c).cast("double") - F.lit(s) for c, s in zip([*x, y], shift)]
    p = len(x)
    sums = {f"_s{i}": F.sum(z[i]) for i in range(p + 1)}
    cross = {f"_q{i}_{j}": F.sum(z[i] * z[j]) for i in range(p + 1) for j in range(i, p + 1)}
    aggs = [F.count(F.lit(1)).alias("n"), *[e.alias(k) for k, e in {**sums, **cross}.items()]]
    flat = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return flat.select(
        *by, "n",
        F.array(*[F.col(f"_s{i}") for i in range(p)]).alias("sum_x"),
        F.col(f"_s{p}").alias("sum_y"),
        F.array(*[F.col(f"_q{i}_{j}") for i in range(p) for j in range(i, p)]).alias("xtx"),
        F.array(*[F.col(f"_q{i}_{p}") for i in range(p)]).alias("xty"),
        F.col(f"_q{p}_{p}").alias("yty"),
    )


def unpack(n, sum_x, sum_y, xtx, xty, yty, shift: np.ndarray) -> Moments:
    """A row of :func:`sufficient_stats` as :class:`Moments`."""
    p = len(sum_x)
    cross = np.zeros((p + 1, p + 1))
    cross[:p, :p][np.triu_indices(p)] = xtx
    cross[:p, p] = xty
    cross[p, p] = yty
    cross = cross + np.triu(cross, 1).T
    return Moments(float(n), np.append(np.asarray(sum_x, float), sum_y), cross, np.asarray(shift, float))


def provisional_shift(df: DataFrame, features: str, label: str | None, p: int) -> np.ndarray:
    """Rough centre of the data from a few leading rows; it guards precision and does not enter the result."""
    cols = [as_array(df, features).alias("x"), (F.col(label).cast("double") if label else F.lit(0.0)).alias("y")]
    head = df.select(*cols).limit(256).toArrow()
    if head.num_rows == 0:
        raise ValueError("empty input")
    z = np.column_stack([matrix(head.column("x")), head.column("y").to_numpy().astype(float)])
    centre = np.nan_to_num(z).mean(axis=0)
    if len(centre) != p + 1:
        raise ValueError("feature vectors differ in length")
    return centre


def _narrow(df: DataFrame, features: str, label: str | None, p: int, by: Sequence[str], shift: np.ndarray) -> dict[tuple, Moments]:
    x = as_array(df, features)
    y = F.col(label) if label else F.lit(0.0)
    rows = sufficient_stats(df, [x[i] for i in range(p)], y, by, shift).collect()
    return {
        tuple(r[b] for b in by): unpack(r["n"], r["sum_x"], r["sum_y"], r["xtx"], r["xty"], r["yty"], shift)
        for r in rows if r["n"]
    }


def _wide(df: DataFrame, features: str, label: str | None, p: int, by: Sequence[str], shift: np.ndarray) -> dict[tuple[int, int], Moments]:
    """Moments per (position in ``by``, value); without ``by`` the only key is (-1, 0)."""
    d = p + 1
    if p > MAX_WIDTH:
        raise ValueError(f"{p} features: a dense cross-product matrix is limited to {MAX_WIDTH}")
    cols = [as_array(df, features).alias("x"), (F.col(label).cast("double") if label else F.lit(0.0)).alias("y")]
    cols += [F.col(b).cast("int").alias(f"g{i}") for i, b in enumerate(by)]

    def fold(batches):
        state: dict[str, np.ndarray] = {}
        for batch in batches:
            z = np.column_stack([matrix(batch.column("x")), batch.column("y").to_numpy(zero_copy_only=False)]) - shift
            groups = [(i, batch.column(f"g{i}").to_numpy(zero_copy_only=False)) for i in range(len(by))] or [(-1, None)]
            for i, g in groups:
                for value in [0] if g is None else np.unique(g):
                    part = z if g is None else z[g == value]
                    key = f"{i}:{int(value)}"
                    if key not in state:
                        if (len(state) + 1) * d * d * 8 > MAX_STATE_BYTES:
                            raise MemoryError("too many groups for this width in one pass; use fewer fold columns at a time")
                        state[key] = np.zeros(1 + d + d * d)
                    acc = state[key]
                    acc[0] += len(part)
                    acc[1:1 + d] += part.sum(axis=0)
                    acc[1 + d:] += (part.T @ part).ravel()
        return state

    out = {}
    for key, acc in reduce_arrays(df.select(*cols), fold).items():
        i, value = key.split(":")
        out[(int(i), int(value))] = Moments(acc[0], acc[1:1 + d], acc[1 + d:].reshape(d, d), shift)
    return out


def moments(df: DataFrame, features: str, label: str | None = None) -> Moments:
    """Moments of the whole table in one pass (the label is 0 when absent)."""
    p = width(df, features)
    shift = provisional_shift(df, features, label, p)
    found = (_narrow if p <= SQL_WIDTH else _wide)(df, features, label, p, [], shift)
    if not found:
        raise ValueError("empty input")
    return next(iter(found.values()))


def fold_moments(df: DataFrame, features: str, label: str, fold_columns: Sequence[str]) -> list[dict[int, Moments]]:
    """Per fold column, moments of each fold. All repeats share one scan.

    Narrow tables group by the combination of all fold columns (5x3 folds: 125
    cells) so no row is copied per repeat; the cells are then added up.
    """
    p = width(df, features)
    shift = provisional_shift(df, features, label, p)
    out: list[dict[int, Moments]] = [{} for _ in fold_columns]
    if p <= SQL_WIDTH:
        for cell, m in _narrow(df, features, label, p, fold_columns, shift).items():
            for r, f in enumerate(cell):
                out[r][f] = out[r].get(f, Moments.zero(shift)) + m
    elif len(fold_columns) * 8 * 8 * (p + 1) ** 2 <= MAX_STATE_BYTES:
        for (r, f), m in _wide(df, features, label, p, fold_columns, shift).items():
            out[r][f] = m
    else:  # very wide: one repeat per pass keeps task memory bounded
        for r, column in enumerate(fold_columns):
            for (_, f), m in _wide(df, features, label, p, [column], shift).items():
                out[r][f] = m
    return out
