"""Exact k-nearest-neighbour join by Euclidean distance, ties by id.

1. Equal vectors are collapsed to one point that carries its smallest ids, so a
   large group of copies costs one point.
2. Points are assigned to the nearest of a bounded set of pivots. Cell radii and
   the nearest points of each cell give an upper bound on every cell's k-th
   neighbour distance; a base point is only sent to cells it can matter for
   (triangle inequality), so nothing is lost.
3. Cells are cut into blocks, as large as memory allows or as small as the cores
   need to be busy. A task meets one query block and one base block and keeps k
   candidates per query under the query's number; candidates are merged by a
   ranked window, which Spark also limits before the shuffle. Shuffled bytes are
   rows x blocks, whatever the vectors' width on the side of the candidates.
4. Blocks meet in rounds of ``ROUND_BYTES`` or a few times the points. A round keeps
   k candidates a query and its shuffle files go, so disk is a multiple of the input
   however many blocks meet. Vectors of single precision travel as such.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fitmesh.functions.vectors import as_array, exact_in_single, matrix
from fitmesh.operators.lookup import keyed_lookup
from fitmesh.session import durable, passing, released

BLOCK_ROWS = 32_768       # rows of one side in one task
_BLOCK_BYTES = 16 << 20   # of their vectors
_LEAST_BLOCK = 2048       # smaller blocks are not worth their shuffle
POINTS_PER_PIVOT = 20_000
MAX_PIVOTS = 4096
ROUND_BYTES = 1 << 30     # of vectors that are shuffled at once
ROUND_TIMES = 4           # or so many times the points, if that is more
_PIVOT_BYTES = 64 << 20   # pivots are shipped with the tasks


def distinct_points(df: DataFrame, id_column: str, vector: str, keep: int) -> DataFrame:
    """``(vec, ids, copies)``: each distinct vector with its ``keep`` smallest ids and its row count."""
    rows = df.select(F.col(id_column).alias("id"), as_array(df, vector).alias("vec"))
    window = Window.partitionBy("vec").orderBy("id")
    ids = (rows.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= keep)
           .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    copies = rows.groupBy("vec").agg(F.count(F.lit(1)).alias("copies"))
    return ids.join(copies, "vec")


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    origin = pivots.mean(axis=0)
    a, b = x - origin, pivots - origin
    sq = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.clip(sq, 0.0, None))


def choose_pivots(points: DataFrame, n_points: int, pivots: int | None) -> np.ndarray:
    """A bounded, hash-chosen set of distinct points."""
    wanted = pivots or int(min(MAX_PIVOTS, max(1, n_points // POINTS_PER_PIVOT)))
    rows = points.select("vec", F.xxhash64("vec").alias("h")).orderBy("h").limit(wanted).collect()
    out = np.array([r["vec"] for r in rows], dtype=float)
    limit = max(1, _PIVOT_BYTES // (8 * out.shape[1]))
    return out[:limit]


def _assign(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds the nearest pivot ``cell`` and the distance ``reach`` to it."""

    @F.arrow_udf("struct<cell int, reach double>")
    def nearest(vec: pa.Array) -> pa.Array:
        if not len(vec):
            cell, reach = np.array([], np.int32), np.array([])
        else:
            d = _distances(matrix(vec), pivots)
            cell = d.argmin(axis=1).astype(np.int32)
            reach = d[np.arange(len(cell)), cell]
        return pa.StructArray.from_arrays([pa.array(cell, pa.int32()), pa.array(reach)], names=["cell", "reach"])

    return points.withColumn("_c", nearest("vec")).select("*", "_c.cell", "_c.reach").drop("_c")


def _bounds(queries: DataFrame, base: DataFrame, pivots: np.ndarray, k: int) -> np.ndarray:
    """Per query cell: radius within which every query's k nearest points must lie, measured from the pivot."""
    n = len(pivots)
    radius = np.full(n, -np.inf)
    for r in queries.groupBy("cell").agg(F.max("reach").alias("r")).collect():
        radius[r["cell"]] = r["r"]
    window = Window.partitionBy("cell").orderBy("reach")
    near = (base.select("cell", "reach").withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= k)
            .select("cell", "reach").collect())  # at most pivots * k rows
    cell = np.array([r["cell"] for r in near], dtype=int)
    reach = np.array([r["reach"] for r in near], dtype=float)
    gap = _distances(pivots, pivots)
    limit = np.full(n, np.inf)
    if len(near) >= k:
        for i in np.flatnonzero(np.isfinite(radius)):
            limit[i] = 2.0 * radius[i] + np.partition(gap[i][cell] + reach, k - 1)[k - 1]
    limit[~np.isfinite(radius)] = -np.inf
    return np.where(np.isfinite(limit), limit * (1.0 + 1e-9) + 1e-9, limit)


def _replicate(base: DataFrame, pivots: np.ndarray, limit: np.ndarray) -> DataFrame:
    """Each base point once per query cell it can matter for."""
    id_type = base.schema["ids"].dataType.simpleString()
    step = max(1, _BLOCK_BYTES // (8 * pivots.size))  # as if every point went to every cell

    def send(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                b = batch.slice(first, step)
                row, cell = np.nonzero(_distances(matrix(b.column("vec")), pivots) <= limit[None, :])
                take = b.select(["vec", "ids"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), take.column(0), take.column(1)],
                                                 names=["cell", "vec", "ids"])

    return base.select("vec", "ids").mapInArrow(send, f"cell int, vec array<double>, ids {id_type}")


def _received(base: DataFrame, pivots: np.ndarray, limit: np.ndarray) -> dict[int, int]:
    """How many points :func:`_replicate` sends to each cell."""

    def count(batches):
        total = np.zeros(len(pivots), np.int64)
        for b in batches:
            if b.num_rows:
                total += (_distances(matrix(b.column("vec")), pivots) <= limit[None, :]).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["cell", "n"])

    rows = base.select("vec").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    return {r["cell"]: r["n"] for r in rows if r["n"]}


def nearest_columns(q: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of all pairs that may be among the ``k`` nearest of a row, near ties included.

    Single precision takes half the time; its slack covers every rounding. Where that lets too many pairs through, double precision does it again.
    """
    size = (q * q).sum(axis=1).max(initial=0.0) + (b * b).sum(axis=1).max(initial=0.0)
    if 1e-20 < size < 1e30:
        found = _near(q.astype(np.float32), b.astype(np.float32), k, (q.shape[1] + 8) * 2.0**-22, 4 * k * len(q) + 1024)
        if found is not None:
            return found
    return _near(q, b, k, 1e-11, None)


def _near(q: np.ndarray, b: np.ndarray, k: int, error: float, most: int | None) -> tuple[np.ndarray, np.ndarray] | None:
    qq, bb = (q * q).sum(axis=1), (b * b).sum(axis=1)
    slack = error * (qq + bb.max()) + 1e-300
    best = np.full((len(q), k), np.inf, q.dtype)  # squared distances less that of the row
    rows, cols, values = [], [], []
    for at in range(0, len(b), _COLUMNS):
        sq = q @ b[at:at + _COLUMNS].T
        sq *= -2.0
        sq += bb[None, at:at + _COLUMNS]
        if not at:
            best[:, :min(k, sq.shape[1])] = np.partition(sq, min(k, sq.shape[1]) - 1, axis=1)[:, :k]
        row, col = np.nonzero(sq <= (best.max(axis=1) + slack).astype(q.dtype)[:, None])
        if most is not None and len(row) > 4 * most:
            return None
        value = sq[row, col]
        if at and len(row):  # the k smallest of the best so far and the new ones
            times = np.bincount(row, minlength=len(q))
            new = np.full((len(q), times.max()), np.inf, q.dtype)
            new[row, np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)] = value
            best = np.partition(np.column_stack([best, new]), k - 1, axis=1)[:, :k]
        rows.append(row)
        cols.append(at + col)
        values.append(value)
    row, col, value = map(np.concatenate, (rows, cols, values))
    keep = value <= (best.max(axis=1) + slack)[row]
    row, col = row[keep], col[keep]
    if most is not None and len(row) > most:
        return None
    order = np.argsort(row, kind="stable")
    return row[order], col[order]


_COLUMNS = 8192
_PAIRS = 1 << 16  # pairs whose differences are held at once


def _meet(k: int, id_kind):
    """Candidates of one query block against one base block."""

    def run(left, right):
        if not left.num_rows or not right.num_rows:
            return pa.table({"qid": pa.array([], pa.int64()), "distance": pa.array([], pa.float64()), "id": pa.array([], id_kind)})
        q, b, qid = matrix(left.column("query")), matrix(right.column("vec")), left.column("qid").to_numpy()
        ids = right.column("ids").combine_chunks()
        size = np.diff(ids.offsets.to_numpy())
        flat = ids.flatten()
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        origin = b.mean(axis=0)
        bc = b - origin
        out_q, out_d, out_i = [], [], []
        step = max(1, (1 << 22) // max(1, min(len(b), _COLUMNS)))
        for at in range(0, len(q), step):
            some = q[at:at + step]
            row, col = nearest_columns(some - origin, bc, min(k, len(b)))
            dist = np.empty(len(row))
            for i in range(0, len(row), _PAIRS):  # near ties are settled by exact differences
                diff = some[row[i:i + _PAIRS]] - b[col[i:i + _PAIRS]]
                dist[i:i + _PAIRS] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
            times = size[col]
            row, dist = np.repeat(row, times), np.repeat(dist, times)
            offset = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            where = np.repeat(starts[col], times) + offset
            who = flat.take(pa.array(where))
            order = pd.DataFrame({"r": row, "d": dist, "i": who.to_pandas()}).sort_values(["r", "d", "i"]).index.to_numpy()
            row = row[order]
            first = np.searchsorted(row, row, side="left")
            keep = np.arange(len(row)) - first < k
            out_q.append(qid[at + row[keep]])
            out_d.append(dist[order[keep]])
            out_i.append(who.take(pa.array(order[keep])))
        return pa.table({"qid": pa.array(np.concatenate(out_q)), "distance": pa.array(np.concatenate(out_d)),
                         "id": pa.chunked_array(out_i, type=id_kind).combine_chunks()})

    return run


def _rounds(left_n: dict[int, int], right_n: dict[int, int], rows: int, row_bytes: int, most: int) -> list[list[tuple[int, int, int, int, int]]]:
    """Rounds of ``(cell, query blocks, base blocks, first base block, last)`` that shuffle ``most`` bytes, or one base block."""
    rounds, size = [[]], 0
    for c in sorted(c for c in left_n if c in right_n):
        lb, rb = -(-left_n[c] // rows), -(-right_n[c] // rows)
        block, at = row_bytes * (left_n[c] + lb * right_n[c] // rb), 0  # all queries of the cell, and a base block for each of their blocks
        while at < rb:
            if size and size + block > most:
                rounds.append([])
                size = 0
            take = min(rb - at, max(1, (most - size) // max(1, block)))
            rounds[-1].append((c, lb, rb, at, at + take - 1))
            at, size = at + take, size + take * block
    return rounds


def nearest_points(queries: DataFrame, base: DataFrame, k: int, pivots: int | None = None,
                   block_rows: int = BLOCK_ROWS, narrow: bool = False) -> DataFrame:
    """``(vec, neighbors)``: the ``k`` nearest ids of every distinct query vector, as sorted structs.

    ``queries`` holds ``vec``; ``base`` holds ``vec, ids`` with at most ``k`` ids per point. ``narrow``: both are exact in single precision.
    """
    spark = base.sparkSession
    n_base = base.count()
    if n_base == 0:
        raise ValueError("no base rows")
    centres = choose_pivots(base, n_base, pivots)
    id_kind = to_arrow_type(base.schema["ids"].dataType.elementType)
    id_type = base.schema["ids"].dataType.elementType.simpleString()
    placed = durable(_assign(queries.select("vec"), centres).withColumn("qid", F.monotonically_increasing_id()))
    # block counts per cell: at most one row per pivot
    left_n = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    limit = None
    if len(centres) == 1:
        right_n = {0: n_base}
    else:
        limit = _bounds(placed, _assign(base, centres), centres, k)
        right_n = _received(base, centres, limit)
    pairs = sum(left_n[c] * right_n[c] for c in left_n if c in right_n)
    busy = int((pairs / (4 * spark.sparkContext.defaultParallelism)) ** 0.5)  # blocks of this size keep all cores at work
    rows = max(1, min(block_rows, _BLOCK_BYTES // (8 * max(1, centres.shape[1])), max(_LEAST_BLOCK, busy)))
    row_bytes = (4 if narrow else 8) * centres.shape[1] + 48
    h, sent_as = F.xxhash64("vec"), F.col("vec").cast("array<float>") if narrow else F.col("vec")
    window = Window.partitionBy("qid").orderBy("distance", "id")
    best = None
    rounds = _rounds(left_n, right_n, rows, row_bytes, max(ROUND_BYTES, ROUND_TIMES * row_bytes * (n_base + sum(left_n.values()))))
    for i, plan in enumerate(rounds):
        if limit is None:
            sent = base.select(F.lit(0).alias("cell"), "vec", "ids")
        else:
            sent = _replicate(base, centres, np.where(np.isin(np.arange(len(centres)), [c for c, *_ in plan]), limit, -np.inf))
        blocks = F.broadcast(spark.createDataFrame(plan, "cell int, lb int, rb int, low int, high int"))
        left = placed.join(blocks, "cell").select(
            F.col("cell").alias("cell"), F.pmod(h, F.col("lb")).cast("int").alias("l"),
            F.explode(F.sequence(F.col("low"), F.col("high"))).alias("r"), "qid", sent_as.alias("query"))
        right = sent.join(blocks, "cell").select("*", F.pmod(h, F.col("rb")).cast("int").alias("r")).where("r between low and high").select(
            F.col("cell").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("lb") - 1)).alias("l"), "r", sent_as.alias("vec"), "ids")
        found = left.groupBy("cell", "l", "r").cogroup(right.groupBy("cell", "l", "r")).applyInArrow(
            _meet(k, id_kind), f"qid long, distance double, id {id_type}")
        found = (found if best is None else found.unionAll(best)).withColumn("_n", F.row_number().over(window)).filter(F.col("_n") <= k).drop("_n")
        if i < len(rounds) - 1:
            found = durable(found)
            if best is not None:
                released(best)
        best = found
    lists = best.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("neighbors"))
    return placed.select("qid", "vec").join(lists, "qid").select("vec", "neighbors")


def knn_join(queries: DataFrame, base: DataFrame | None, k: int, query_id: str = "id", base_id: str | None = None,
             vector: str = "features", base_vector: str | None = None, pivots: int | None = None,
             block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, neighbor_id, distance, rank)`` with ``rank`` 1..k.

    ``base=None`` joins the table with itself and leaves each row out of its own
    list (rows with the same vector but another id stay).
    """
    if k < 1:
        raise ValueError("k must be positive")
    itself = base is None
    want = k + 1 if itself else k
    source, source_vector = (queries, vector) if itself else (base, base_vector or vector)
    narrow = exact_in_single(queries, vector) and exact_in_single(source, source_vector)
    with passing(queries.sparkSession):
        base_points = durable(distinct_points(source, query_id if itself else (base_id or query_id), source_vector, want))
        if itself:
            query_points = base_points.select("vec", "copies")
        else:
            query_points = durable(queries.select(as_array(queries, vector).alias("vec")).groupBy("vec").agg(
                F.count(F.lit(1)).alias("copies")))
        lists = durable(nearest_points(query_points, base_points, want, pivots, block_rows, narrow).join(query_points, "vec"))
    rows = queries.select(F.col(query_id).alias("query_id"), as_array(queries, vector).alias("vec"))
    sample = lists.select("vec").first()
    size = len(sample["vec"]) if sample else 0
    matched = keyed_lookup(rows, lists, "vec", "copies", row_bytes=8 * size + 32 * want + 64)
    neighbors = F.col("neighbors")
    if itself:
        neighbors = F.filter(neighbors, lambda e: e["id"] != F.col("query_id"))
    return matched.select("query_id", F.posexplode(F.slice(neighbors, 1, k)).alias("_r", "_e")).select(
        "query_id", F.col("_e.id").alias("neighbor_id"), F.col("_e.distance").alias("distance"), (F.col("_r") + 1).alias("rank"))
