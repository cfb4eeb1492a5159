"""Exact order statistics of many columns without sorting the table.

Doubles are read as 64-bit integers of the same order. A pass counts rows by the next bits of that integer, only inside the
cells that hold a requested position, for all columns in one grouped shuffle; cells that would still send more than
``_CELL_ROWS`` rows are cut further, and all of them if together they would send a large part of the table. What is left is small: a last pass ranks the distinct values of each cell with counts.
Equal values collapse before every shuffle, so a hot value costs one row per batch, and no task gets more than a cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fitmesh.operators.packed import row_blocks

_CELL_ROWS = 250_000  # rows of one cell in the last shuffle
_SENT = 1_000_000  # rows of all cells in the last shuffle, or a sixteenth of the table
_COUNTERS = 1 << 18  # parts of cells that a pass for their sum may count
_BITS = 8  # a cell is cut into 2**_BITS
_TOP = np.uint64(1 << 63)
Reader = Callable[[Iterator[pa.RecordBatch]], Iterator[Callable[[str], np.ndarray]]]  # the values of a column, by its name, for each batch


def _ordered(v: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles; both zeros are one value."""
    u = (v + 0.0).view(np.uint64)
    return np.where(u & _TOP, ~u, u | _TOP)


def _doubles(u: np.ndarray) -> np.ndarray:
    return np.where(u & _TOP, u ^ _TOP, ~u).view(np.float64)


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[Callable[[str], np.ndarray]]:
    for batch in batches:
        yield lambda name: batch.column(name).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)


def _distinct(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct present values, with their counts."""
    return np.unique(_ordered(v[~np.isnan(v)]), return_counts=True)


@dataclass
class _Cell:
    """Integers from ``low`` whose last ``shift`` bits are free; ``before`` rows lie below, ``wanted`` positions inside."""

    low: int
    shift: int
    before: int
    wanted: list[int]


def _locate(cells: Sequence[_Cell]):
    """Which of the cells (ascending, apart) a sorted array of integers falls into, and which entries fall into one."""
    low = np.array([c.low for c in cells], np.uint64)
    last = np.array([c.low + (1 << c.shift) - 1 for c in cells], np.uint64)

    def run(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(low, u, "right") - 1
        inside = np.flatnonzero((at >= 0) & (u <= last[at]))
        return inside, at[inside]

    return run


def _children(data: DataFrame, names: Sequence[str], cells: Mapping[str, list[_Cell]], bits: int, read: Reader) -> dict[tuple[int, int], list]:
    """Per (column, cell) its parts with rows as ``(part, rows, rows a shuffle would carry)``, ascending."""

    def count(batches):
        find = {n: _locate(cells[n]) for n in names if cells[n]}
        low = {n: np.array([c.low for c in cells[n]], np.uint64) for n in find}
        shift = {n: np.array([max(c.shift - bits, 0) for c in cells[n]], np.uint64) for n in find}
        for values in read(batches):
            for n in find:
                u, times = _distinct(values(n))
                inside, at = find[n](u)
                part = ((u[inside] - low[n][at]) >> shift[n][at]).astype(np.int64)
                if not len(part):
                    continue
                key = at << bits | part
                start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(start), names.index(n)), pa.int32()), pa.array(key[start]),
                    pa.array(np.add.reduceat(times[inside], start)), pa.array(np.diff(np.append(start, len(key))))], names=["col", "key", "n", "d"])

    out: dict[tuple[int, int], list] = {}
    counted = data.mapInArrow(count, "col int, key long, n long, d long").groupBy("col", "key").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    # 2**bits rows at most for each cell, and as many cells as positions
    for r in sorted(counted.collect(), key=lambda r: (r["col"], r["key"])):
        out.setdefault((r["col"], r["key"] >> bits), []).append((r["key"] & (1 << bits) - 1, r["n"], r["d"]))
    return out


def order_statistics(df: DataFrame, columns: Sequence[str], positions_of) -> tuple[dict[str, int], dict[str, dict[int, float]]]:
    """Values at 0-based sorted positions; nulls and NaNs are left out.

    ``positions_of(column, n)`` returns the positions wanted among the ``n``
    present values. The result is ``(counts, {column: {position: value}})``.
    """
    columns = list(columns)
    names = [f"c{i}" for i in range(len(columns))]
    data = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(n) for c, n in zip(columns, names)])
    return _search(data, columns, names, positions_of, _columns)


def block_order_statistics(blocks: DataFrame, p: int, features: Sequence[int], positions_of) -> tuple[dict[int, int], dict[int, dict[int, float]]]:
    """``order_statistics`` of some features of a table of ``pack_rows``, by their numbers."""
    rows_of, number = row_blocks(p, {}), {f"c{i}": i for i in features}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[Callable[[str], np.ndarray]]:
        for (x,) in rows_of(batches):
            yield lambda name: x[:, number[name]]

    return _search(blocks.select("x"), list(features), list(number), positions_of, read)


def _search(data: DataFrame, columns: list, names: list[str], positions_of, read: Reader) -> tuple[dict, dict]:
    bits = 16 if len(columns) <= 64 else 12  # sign, exponent and the first bits of the fraction at once
    open_cells = {n: [_Cell(0, 64, 0, [])] for n in names}
    ready: dict[str, list[_Cell]] = {n: [] for n in names}
    found: dict[str, dict[int, float]] = {c: {} for c in columns}
    totals: dict[str, int] = {}
    while any(open_cells.values()):
        parts, light, sending = _children(data, names, open_cells, bits, read), [], 0
        for i, (c, n) in enumerate(zip(columns, names)):
            cut = []
            for k, cell in enumerate(open_cells[n]):
                own = parts.get((i, k), [])
                if c not in totals:
                    totals[c] = sum(rows for _, rows, _ in own)
                    cell.wanted = sorted({int(p) for p in positions_of(c, totals[c])}) if totals[c] else []
                shift, before, at = max(cell.shift - bits, 0), cell.before, 0
                for part, rows, sent in own:
                    inside = []
                    while at < len(cell.wanted) and cell.wanted[at] < before + rows:
                        inside.append(cell.wanted[at])
                        at += 1
                    one = _Cell(cell.low + (part << shift), shift, before, inside)
                    if inside and shift == 0:
                        value = float(_doubles(np.array([one.low], np.uint64))[0])
                        found[c].update(dict.fromkeys(inside, value))
                    elif inside and sent <= _CELL_ROWS:
                        light.append((n, one))
                        sending += sent
                    elif inside:
                        cut.append(one)
                    before += rows
            open_cells[n] = cut
        again = sending > max(_SENT, max(totals.values()) // 16) and len(light) << _BITS <= _COUNTERS
        for n, one in light:
            (open_cells if again else ready)[n].append(one)
        for cut in open_cells.values():
            cut.sort(key=lambda c: c.low)
        bits = _BITS
    if not any(ready.values()):
        return totals, found

    cells = {n: sorted(ready[n], key=lambda c: c.low) for n in names}

    def tally(batches):
        find = {n: _locate(cells[n]) for n in names if cells[n]}
        for values in read(batches):
            for n in find:
                u, times = _distinct(values(n))
                inside, at = find[n](u)
                if len(inside):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(inside), names.index(n)), pa.int32()), pa.array(at, pa.int32()),
                        pa.array(_doubles(u[inside])), pa.array(times[inside])], names=["col", "cell", "value", "times"])

    distinct = data.mapInArrow(tally, "col int, cell int, value double, times long") \
        .groupBy("col", "cell", "value").agg(F.sum("times").alias("times"))
    window = Window.partitionBy("col", "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    running = distinct.select("col", "cell", "value", "times", F.sum("times").over(window).alias("upto"))

    def pick(batches):
        before = {n: np.array([c.before for c in cells[n]], np.int64) for n in names}
        wanted = {n: np.array(sorted(p for c in cells[n] for p in c.wanted), np.int64) for n in names}
        for b in batches:
            col, cell = b.column("col").to_numpy(), b.column("cell").to_numpy()
            value, times, upto = (b.column(c).to_numpy() for c in ("value", "times", "upto"))
            for i in np.unique(col):
                n, rows = names[i], np.flatnonzero(col == i)
                end = before[n][cell[rows]] + upto[rows]
                start = end - times[rows]
                first = np.searchsorted(wanted[n], start, side="left")
                last = np.searchsorted(wanted[n], end, side="left")
                hit = np.repeat(np.arange(len(rows)), last - first)
                if len(hit):
                    at = np.concatenate([np.arange(a, z) for a, z in zip(first, last) if z > a])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), i), pa.int32()),
                                                      pa.array(wanted[n][at]), pa.array(value[rows][hit])],
                                                     names=["col", "position", "value"])

    # one row per requested position
    for r in running.mapInArrow(pick, "col int, position long, value double").collect():
        found[columns[r["col"]]][r["position"]] = r["value"]
    return totals, found


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict[str, np.ndarray]:
    """Exact quantiles with linear interpolation between order statistics."""

    def positions(_, n):
        at = np.asarray(probabilities) * (n - 1)
        return np.concatenate([np.floor(at), np.ceil(at)]).astype(np.int64)

    totals, found = order_statistics(df, columns, positions)
    return {c: interpolate(found[c], np.asarray(probabilities, float) * (totals[c] - 1)) for c in columns}


def interpolate(found: Mapping[int, float], at: np.ndarray) -> np.ndarray:
    if not found:
        return np.full(len(at), np.nan)
    lo, hi = np.floor(at).astype(np.int64), np.ceil(at).astype(np.int64)
    a = np.array([found[i] for i in lo])
    b = np.array([found[i] for i in hi])
    return a + (b - a) * (at - lo)
