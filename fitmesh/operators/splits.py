"""Seeded hold-out and k-fold assignment.

Rows are ordered by a hash of their key. Exact split sizes only need the hash
values at the cut ranks, so the data is never sorted or shuffled: histograms of
the hash locate the cuts, only the cells that hold one are sorted, and the
assignment itself is a projection.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fitmesh.functions.hashing import HEX_DIGITS, HIGHEST, key_hash, key_hex

_STEP = 3                 # hexadecimal digits resolved per histogram pass: 4096 cells
_COLLECT_LIMIT = 1_000_000  # hashes of one histogram cell that one task sorts


def _long(df: DataFrame, hashes: Sequence[Column], cells: set[tuple[int, str]] | None = None, digits: int = 0) -> DataFrame:
    """``series, h`` of every hash, or of those within cells; rows are tested before they become one row a series."""
    if cells is not None:
        inside = [F.substring(h, 1, digits).isin(sorted(c for s, c in cells if s == i)) for i, h in enumerate(hashes) if any(s == i for s, _ in cells)]
        df = df.where(reduce(or_, inside))
    if len(hashes) == 1:
        return df.select(F.lit(0).alias("series"), hashes[0].alias("h"))
    entry = F.explode(F.array(*[F.struct(F.lit(i).alias("series"), h.alias("h")) for i, h in enumerate(hashes)]))
    long = df.select(entry.alias("e")).select("e.series", "e.h")
    return long if cells is None else long.where(F.concat_ws("/", "series", F.substring("h", 1, digits)).isin([f"{s}/{c}" for s, c in sorted(cells)]))


def _at_ranks(df: DataFrame, hashes: Sequence[Column], digits: int, ranks: set[tuple[int, str, int]]) -> dict[tuple[int, str, int], str]:
    """The hash at each ``(series, cell, rank in the cell)``; the driver gets one row a rank."""
    cell = F.substring("h", 1, digits)
    rank = F.row_number().over(Window.partitionBy("series", "cell").orderBy("h")) - 1
    long = _long(df, hashes, {(s, c) for s, c, _ in ranks}, digits).withColumn("cell", cell).withColumn("rank", rank)
    rows = long.where(F.concat_ws("/", "series", "cell", "rank").isin(["/".join(map(str, r)) for r in sorted(ranks)])).collect()
    return {(r["series"], r["cell"], r["rank"]): r["h"] for r in rows}


def _histogram(df: DataFrame, hashes: Sequence[Column], digits: int, parents: set[tuple[int, str]] | None) -> dict:
    """Counts per (series, leading digits); ``parents`` restricts to cells one step coarser."""
    long = _long(df, hashes, parents, digits - _STEP)
    rows = long.groupBy("series", F.substring("h", 1, digits).alias("cell")).count().collect()
    return {(r["series"], r["cell"]): r["count"] for r in rows}


def hash_cuts(df: DataFrame, hashes: Sequence[Column], ranks_of) -> tuple[int, list[list[str]]]:
    """Exact hash texts at given ranks.

    ``ranks_of(n)`` returns the ascending cut ranks. The result holds one list
    per hash series; cut ``c`` is the hash at that rank, so ``hash < c`` selects
    ``rank`` rows when hashes are distinct. Rows sharing a key always fall on
    the same side.
    """
    digits = _STEP
    counts = _histogram(df, hashes, digits, None)
    n = sum(v for (s, _), v in counts.items() if s == 0)
    ranks = ranks_of(n)
    done = {(s, i): HIGHEST for s in range(len(hashes)) for i, r in enumerate(ranks) if r >= n}
    # (series, cut) -> leading digits known so far, ranks still to skip
    todo = {(s, i): ("", r) for s in range(len(hashes)) for i, r in enumerate(ranks) if r < n}
    while todo:
        located = {}
        for (s, i), (parent, skip) in todo.items():
            for c in sorted(c for (cs, c) in counts if cs == s and c.startswith(parent)):
                if skip < counts[(s, c)]:
                    located[(s, i)] = (c, skip)
                    break
                skip -= counts[(s, c)]
        if digits == HEX_DIGITS:
            done.update({key: c for key, (c, _) in located.items()})
            break
        small = {(s, i): (s, c, skip) for (s, i), (c, skip) in located.items() if counts[(s, c)] <= _COLLECT_LIMIT}
        if small:
            values = _at_ranks(df, hashes, digits, set(small.values()))
            done.update({key: values[at] for key, at in small.items()})
        todo = {key: at for key, at in located.items() if key not in small}
        if todo:
            digits += _STEP
            counts = _histogram(df, hashes, digits, {(s, c) for (s, _), (c, _) in todo.items()})
    return n, [[done[(s, i)] for i in range(len(ranks))] for s in range(len(hashes))]


def fold_ranks(n: int, n_splits: int) -> list[int]:
    """Start ranks of folds 1..k-1; the first ``n % k`` folds hold one row more."""
    base, extra = divmod(n, n_splits)
    return [f * base + min(f, extra) for f in range(1, n_splits)]


def holdout_split(df: DataFrame, key: Sequence[str], test_size: float = 0.2, seed: int = 42,
                  mode: str = "exact", out: str = "is_test") -> DataFrame:
    """Mark ``ceil(test_size * n)`` rows as test. ``mode="fast"`` needs no pass but its size is approximate."""
    h = key_hex(key, seed)
    if mode == "fast":
        cut = f"{int(test_size * 16 ** HEX_DIGITS):0{HEX_DIGITS}x}" if test_size < 1 else HIGHEST
    elif mode == "exact":
        _, cuts = hash_cuts(df, [h], lambda n: [math.ceil(round(test_size * n, 9))])
        cut = cuts[0][0]
    else:
        raise ValueError("mode must be 'exact' or 'fast'")
    return df.withColumn(out, h < F.lit(cut))


def _fold_of(h: Column, cuts: Sequence[str]) -> Column:
    """The number of cuts at or below the hash."""
    out = F.lit(0)
    for cut in cuts:
        out = out + (h >= F.lit(cut)).cast("int")
    return out.cast("int")


def kfold(df: DataFrame, key: Sequence[str], n_splits: int = 5, seed: int = 42,
          mode: str = "exact", out: str = "fold") -> DataFrame:
    """Disjoint, covering folds whose sizes differ by at most one row (``exact``)."""
    return _assign(df, key, n_splits, [(out, (seed,))], mode)


def repeated_kfold(df: DataFrame, key: Sequence[str], n_splits: int = 5, n_repeats: int = 3, seed: int = 42,
                   mode: str = "exact", prefix: str = "fold_r") -> DataFrame:
    """Columns ``fold_r0..``: one independent shuffle per repeat, without copying rows."""
    return _assign(df, key, n_splits, [(f"{prefix}{r}", (seed, r)) for r in range(n_repeats)], mode)


def _assign(df: DataFrame, key: Sequence[str], n_splits: int, series: Sequence[tuple[str, tuple[int, ...]]], mode: str) -> DataFrame:
    if mode == "fast":
        return df.withColumns({c: F.pmod(key_hash(key, *salt), F.lit(n_splits)).cast("int") for c, salt in series})
    if mode != "exact":
        raise ValueError("mode must be 'exact' or 'fast'")
    _, cuts = hash_cuts(df, [key_hex(key, *salt) for _, salt in series], lambda n: fold_ranks(n, n_splits))
    hashed = df.withColumns({f"_h_{c}": key_hex(key, *salt) for c, salt in series})
    return hashed.withColumns({c: _fold_of(F.col(f"_h_{c}"), cut) for (c, _), cut in zip(series, cuts)}).drop(
        *[f"_h_{c}" for c, _ in series])


def folds_long(df: DataFrame, fold_columns: Sequence[str]) -> DataFrame:
    """One row per (row, repeat) with columns ``repeat`` and ``fold``."""
    rest = [c for c in df.columns if c not in set(fold_columns)]
    pairs = ", ".join(f"{r}, `{c}`" for r, c in enumerate(fold_columns))
    return df.select(*rest, F.expr(f"stack({len(fold_columns)}, {pairs}) as (repeat, fold)"))
