"""Rows in blocks: a row of the table holds the features, or their bin numbers, and values of a few thousand rows as bytes.

Passes over such a table hand NumPy whole arrays and cost Spark next to nothing per row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from fitmesh.functions.vectors import matrix
from fitmesh.operators.partials import reduce_arrays

_BLOCK_BYTES = 4 << 20  # of bin numbers, or of features and values, in one block


def pack_rows(df: DataFrame, p: int, keep: Sequence[str]) -> DataFrame:
    """``n, x`` and the 8-byte columns ``keep`` of ``df(x, ...)``. Rows without the first of ``keep`` have blocks of their own, where it is null."""
    step = max(1, _BLOCK_BYTES // (8 * (p + len(keep))))

    def block(parts: list[pa.RecordBatch], known: bool) -> pa.RecordBatch:
        x = np.concatenate([matrix(b.column("x")) for b in parts])
        values = [b"".join(b.column(c).to_numpy().tobytes() for b in parts) if known or c != keep[0] else None for c in keep]
        return pa.RecordBatch.from_arrays([pa.array([len(x)]), *[pa.array([v], pa.binary()) for v in (x.T.tobytes(), *values)]], names=["n", "x", *keep])  # a feature's values side by side

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[bool, list[pa.RecordBatch]] = {True: [], False: []}
        for batch in batches:
            present = batch.column(keep[0]).is_valid()
            for known, own in ((True, batch.filter(present)), (False, batch.filter(pc.invert(present)))):
                for at in range(0, own.num_rows, step):
                    b = own.slice(at, step)
                    if sum(w.num_rows for w in waiting[known]) + b.num_rows > step:
                        yield block(waiting[known], known)
                        waiting[known] = []
                    waiting[known].append(b)
        yield from (block(parts, known) for known, parts in waiting.items() if parts)

    return df.mapInArrow(run, ", ".join(["n long", "x binary", *[f"{c} binary" for c in keep]]))


def row_blocks(p: int, kinds: dict[str, type]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, ...]]]:
    """Iterates over the blocks of ``pack_rows``: features as (rows, features), then the columns of ``kinds``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            x, columns = batch.column("x"), [(batch.column(c), k) for c, k in kinds.items()]
            for i in range(batch.num_rows):
                yield np.frombuffer(x[i].as_buffer()).reshape(p, -1).T, *[np.frombuffer(c[i].as_buffer(), k) for c, k in columns]

    return run


def count_and_mean(df: DataFrame, column: str) -> tuple[int, float]:
    """Of the present values of a column of ``pack_rows``."""

    def fold(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        n = total = 0.0
        for b in batches:
            for v in b.column(column):
                n, total = n + v.as_buffer().size // 8, total + np.frombuffer(v.as_buffer()).sum()
        return {"s": np.array([n, total])}

    n, total = reduce_arrays(df.where(f"{column} is not null").select(column), fold).get("s", (0.0, 0.0))
    return int(n), float(total / n) if n else math.nan


def _bins(x: np.ndarray, cuts: list[np.ndarray], kind: type) -> bytes:
    bins = np.empty((len(cuts), len(x)), kind)  # a feature's bins side by side
    for j, c in enumerate(cuts):
        bins[j] = np.searchsorted(c, x[:, j], "left")
    return bins.tobytes()


def _kind(cuts: list[np.ndarray]) -> type:
    return np.uint8 if max(map(len, cuts), default=0) < 256 else np.uint16


def pack_blocks(df: DataFrame, cuts: list[np.ndarray], keep: Sequence[str], more: dict[str, float] | None = None) -> DataFrame:
    """What ``pack`` returns, of the blocks of ``pack_rows``."""
    kind, more, rows_of = _kind(cuts), more or {}, row_blocks(len(cuts), {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (x,) in enumerate(rows_of([batch])):
                values = [np.full(len(x), v).tobytes() for v in more.values()]
                yield pa.RecordBatch.from_arrays([pa.array([len(x)]), pa.array([_bins(x, cuts, kind)], pa.binary()), *[batch.column(c).slice(i, 1) for c in keep],
                                                  *[pa.array([v], pa.binary()) for v in values]], names=["n", "b", *keep, *more])

    return df.mapInArrow(run, ", ".join(["n long", "b binary", *[f"{c} binary" for c in (*keep, *more)]]))


def pack(df: DataFrame, cuts: list[np.ndarray], keep: Sequence[str], more: dict[str, float] | None = None) -> DataFrame:
    """``n, b`` and the 8-byte columns ``keep`` of ``df(x, ...)``; ``more`` adds columns of one value. Rows at or below a cut are in its bin."""
    kind, more = _kind(cuts), more or {}
    step = max(1, _BLOCK_BYTES // max(1, len(cuts) * np.dtype(kind).itemsize))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                b = batch.slice(at, step)
                bins = _bins(matrix(b.column("x")), cuts, kind)
                values = [b.column(c).to_numpy().tobytes() for c in keep] + [np.full(b.num_rows, v).tobytes() for v in more.values()]
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), *[pa.array([v], pa.binary()) for v in (bins, *values)]], names=["n", "b", *keep, *more])

    return df.mapInArrow(run, ", ".join(["n long", "b binary", *[f"{c} binary" for c in (*keep, *more)]]))


def blocks(p: int, kinds: dict[str, type]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, ...]]]:
    """Iterates over the blocks of Arrow batches: bins as (rows, features), then the columns of ``kinds``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            b, columns = batch.column("b"), [(batch.column(c), k) for c, k in kinds.items()]
            for i in range(batch.num_rows):
                n, data = batch.column("n")[i].as_py(), b[i].as_buffer()
                bins = np.frombuffer(data, np.uint8 if data.size <= n * p else np.uint16).reshape(p, n)
                yield bins.T, *[np.frombuffer(c[i].as_buffer(), k) for c, k in columns]

    return run


def sums(bins: np.ndarray, slot: np.ndarray, size: int, width: int, values: Sequence[np.ndarray | None], out: np.ndarray) -> None:
    """Adds ``values`` (None: rows) up per (slot, feature, bin) into ``out`` (values, size, features, width)."""
    for j in range(bins.shape[1]):
        index = slot * width + bins[:, j]
        for k, v in enumerate(values):
            out[k, :, j] += np.bincount(index, v, minlength=size * width).reshape(size, width)
