"""Importance resampling towards a target distribution with hashed n-gram features.

A feature's bucket is the CRC-32 of its bytes. The CRCs of a slice of texts are computed as matrices: distinct features of
equal length are the rows of one two-dimensional uint8 array, and one table step per column updates the CRCs of all its rows
at once. Features longer than a piece are laid out as rows of pieces, whose CRCs are joined by the linear map that
appending zero bytes is. The buckets are scattered back to where the features stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.llm.storage import stored
from fitmesh.llm.words import SLICE_BYTES, mix, slices, text_buffers
from fitmesh.operators.rank import ordered_rank

PIECE = 256  # bytes; longer features are joined from pieces
MATRIX_BYTES = 1 << 22  # at most this much is laid out at once
_POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, reflected
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(_POLYNOMIAL), c >> 1)
    return c


_TABLE = _table()


def _columns(rows: np.ndarray, register: np.ndarray) -> np.ndarray:
    for k in range(rows.shape[1]):
        register = _TABLE[(register ^ rows[:, k]) & np.uint32(255)] ^ (register >> np.uint32(8))
    return register


def crc_rows(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a two-dimensional uint8 array."""
    return ~_columns(rows, np.full(len(rows), 0xFFFFFFFF, np.uint32))


def _zeros_map() -> np.ndarray:
    """What ``PIECE`` zero bytes do to a CRC, as one table per byte of it."""
    bits = _columns(np.zeros((32, PIECE), np.uint8), np.uint32(1) << np.arange(32, dtype=np.uint32))
    byte = np.arange(256, dtype=np.uint32)
    return np.array([[np.bitwise_xor.reduce(bits[8 * k : 8 * k + 8][(b >> np.arange(8)) & 1 == 1], initial=np.uint32(0)) for b in byte] for k in range(4)], np.uint32)


_SHIFT = _zeros_map()


def _gather(data: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(data, size)[start]


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row number for each distinct row, and for all rows which of these they equal."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    packed = wide.view(np.uint64)
    key = packed[:, 0].copy()
    for k in range(1, packed.shape[1]):
        key = mix(key) ^ packed[:, k]
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    if packed.shape[1] > 1:
        odd = np.flatnonzero((packed != packed[first[inverse]]).any(1))  # equal keys of unequal bytes stand for themselves
        inverse[odd] = len(first) + np.arange(len(odd))
        first = np.append(first, odd)
    return first, inverse


def crc_spans(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans ``data[start:start + size]``."""
    out = np.zeros(len(start), np.uint32)
    head = np.where(size > PIECE, size % PIECE, size)
    order = np.argsort(head, kind="stable")
    ends = np.flatnonzero(np.diff(head[order], append=-1))
    begin = 0
    for end in ends:
        length = int(head[order[begin]])
        step = max(1, MATRIX_BYTES // max(length, 1))
        for at in range(begin, end + 1, step) if length else ():
            some = order[at : min(at + step, end + 1)]
            rows = _gather(data, start[some], length)
            first, inverse = _distinct(rows)
            out[some] = crc_rows(rows[first])[inverse]
        begin = end + 1
    long = np.flatnonzero(size > PIECE)
    left, at = size[long] // PIECE, start[long] + head[long]
    while len(long):
        crc, step = out[long], MATRIX_BYTES // PIECE
        moved = _SHIFT[0][crc & 255] ^ _SHIFT[1][(crc >> 8) & 255] ^ _SHIFT[2][(crc >> 16) & 255] ^ _SHIFT[3][crc >> 24]
        own = np.concatenate([crc_rows(_gather(data, at[k : k + step], PIECE)) for k in range(0, len(at), step)])
        out[long] = moved ^ own
        left, at = left - 1, at + PIECE
        more = left > 0
        long, left, at = long[more], left[more], at[more]
    return out


def _features(column: pa.Array, longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per slice: the first row, words per row, features per row, and the bucket of every feature in row order."""
    data, offsets = text_buffers(column)
    for i, j in slices(offsets, SLICE_BYTES // longest):
        part, bounds = _LOWER[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i]
        inside = _WORD[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[bounds] = True
        start = np.flatnonzero(inside & (np.append(True, ~inside[:-1]) | edge[:-1])) if len(part) else np.zeros(0, np.int64)
        end = np.flatnonzero(inside & (np.append(~inside[1:], True) | edge[1:])) + 1 if len(part) else np.zeros(0, np.int64)
        first = np.searchsorted(start, bounds)
        size = end - start
        # the words joined by one space: a run of words is one span of it
        joined = np.full(int(size.sum()) + len(size), 32, np.uint8)
        to = np.cumsum(size + 1) - size - 1
        joined[np.repeat(to - start, size) + np.flatnonzero(inside)] = part[inside]
        words = np.diff(first)
        row, spot, length = [], [], []
        for n in range(1, longest + 1):
            count = np.maximum(words - n + 1, 0)
            at = np.repeat(first[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
            row.append(np.repeat(np.arange(len(words)), count))
            spot.append(to[at])
            length.append(to[at + n - 1] + size[at + n - 1] - to[at])
        row, spot, length = map(np.concatenate, (row, spot, length))
        order = np.argsort(row, kind="stable")
        bucket = crc_spans(joined, spot[order], length[order]) % np.uint32(buckets)
        yield i, words, np.bincount(row, minlength=len(words)), bucket


def _bucketed(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, words, count, bucket in _features(batch.column("text"), longest, buckets):
                packed = bucket.astype("<u4")
                ends = 4 * np.concatenate([[0], np.cumsum(count)])
                blob = pa.Array.from_buffers(pa.large_binary(), len(count), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(i, len(words)), pa.array(words.astype(np.int64)), pa.array(count.astype(np.int64)), blob.cast(pa.binary())],
                    names=["id", "n_words", "n_features", "buckets"])

    return run


def _counts(buckets: int):
    """Features per bucket of a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            total += np.bincount(data[offsets[0] : offsets[-1]].view("<u4") if len(data) else [], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    return run


def _weights(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("buckets"))
            bucket = data[offsets[0] : offsets[-1]].view("<u4") if len(data) else np.zeros(0, np.uint32)
            total = np.concatenate([[0], np.cumsum(gain[bucket])])
            at = (offsets - offsets[0]) // 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_words"), batch.column("n_features"), pa.array(total[at[1:]] - total[at[:-1]])],
                names=["id", "n_words", "n_features", "weight"])

    return run


def resample(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text", target_text: str = "text", longest: int = 2,
             buckets: int = 10_000, min_words: int = 20, percent: int = 10, seed: int = 2024) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row: draws documents that look like ``target``.

    Words are runs of ASCII letters, digits and non-ASCII characters (A-Z lower-cased); features are runs of 1 to ``longest``
    words. A bucket's gain is 1000 times the log ratio of its add-one share in ``target`` to that in ``docs``, rounded down;
    ``weight`` sums the gains of a row's features, ``score`` adds Gumbel noise drawn from ``seed`` and the id. Of the rows with
    an id and at least ``min_words`` words the ``percent`` % with the highest scores are ranked (ties: smaller id, then fewer
    features); the others have a null rank, which samples without replacement in proportion to the importance weights.

    Null, empty and wordless texts have no features and weight 0. A null id has no score and is neither counted nor drawn.
    Rows that repeat an id are drawn each for itself, with the same noise. An empty target or empty documents give
    add-one shares. Other columns are ignored. Counts cover all rows; ``buckets`` numbers reach the driver.
    """
    spark = docs.sparkSession
    schema = "id long, n_words long, n_features long, buckets binary"

    def features(df: DataFrame, name: str, column: str, key) -> DataFrame:
        return stored(df.select(key.alias("id"), F.col(f"`{column}`").alias("text")).mapInArrow(_bucketed(longest, buckets), schema), name)

    rows = features(docs, "features", text_column, F.col(f"`{id_column}`").cast("long"))
    wanted = features(target, "target", target_text, F.lit(None).cast("long"))
    count = lambda df, name: df.select("buckets").mapInArrow(_counts(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias(name))
    both = spark.range(buckets).select(F.col("id").alias("bucket")).join(count(rows, "s"), "bucket", "left").join(count(wanted, "t"), "bucket", "left").fillna(0)
    seen = {r["bucket"]: (r["s"], r["t"]) for r in both.collect()}  # bounded by `buckets`
    s, t = (np.array([seen[b][k] for b in range(buckets)], np.float64) for k in (0, 1))
    gain = np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)
    weighed = rows.mapInArrow(_weights(gain), "id long, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = stored(weighed.withColumn("score", (F.col("weight") + noise).cast("long")), "scored")
    able = F.col("id").isNotNull() & (F.col("n_words") >= min_words)
    drawn = scored.where(able).count() * percent // 100
    names = [F.col("id").alias("doc_id"), "n_words", "n_features", "weight", "score"]
    order = [F.desc("score"), F.asc("id"), F.asc("n_features"), F.asc("n_words")]
    ranked = ordered_rank(scored.where(able), order).select(*names, F.when(F.col("rank") < drawn, F.col("rank") + 1).alias("rank"))
    return ranked.unionAll(scored.where(~able).select(*names, F.lit(None).cast("long").alias("rank")))
