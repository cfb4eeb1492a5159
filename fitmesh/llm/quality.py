"""Quality rules: base counts, and repetition coverage by rolling hashes of several n-gram lengths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.llm.words import Words, mix, span_hash, words

COVERAGE = {5: 0.45, 8: 0.30, 10: 0.30}  # share of a text's word characters that may lie in repeated n-grams
LINES = 0.30  # share of word characters in lines that repeat an earlier line
SYMBOLS = 0.10  # symbols per word
_WINDOW = 8
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def measure(w: Words, lengths: list[int]) -> dict[str, np.ndarray]:
    """Counts per row of one slice."""
    points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])
    size = points[w.end] - points[w.start]
    own = mix(np.arange(1, w.rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = {"n_words": np.diff(w.first), "word_chars": _sums(size, w.first)}
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[w.data])])
    out["n_symbols"] = symbols[w.bounds[1:]] - symbols[w.bounds[:-1]]

    newline = np.flatnonzero(w.data == 10)
    row_of = np.searchsorted(w.bounds, newline, "right") - 1
    begin = np.concatenate([w.bounds[:-1], newline + 1])
    row = np.concatenate([np.arange(w.rows), row_of])
    order = np.lexsort((begin, row))
    begin, row = begin[order], row[order]
    stop = np.empty(len(begin), np.int64)
    if len(begin):
        last = np.append(row[1:] != row[:-1], True)
        stop[:-1] = begin[1:] - 1
        stop[last] = w.bounds[1:][row[last]]
    f, t = np.searchsorted(w.start, begin), np.searchsorted(w.start, stop)
    real = t > f
    begin, stop, row, f, t = begin[real], stop[real], row[real], f[real], t[real]
    _, at = np.unique(mix(span_hash(w.data, begin, stop) + own[row]), return_index=True)
    again = np.ones(len(row), bool)
    again[at] = False
    out["n_dup_lines"] = np.bincount(row[again], minlength=w.rows)
    chars = np.concatenate([[0], np.cumsum(size)])
    out["dup_line_chars"] = np.bincount(row[again], (chars[t] - chars[f])[again], minlength=w.rows).astype(np.int64)

    for n in lengths:
        keys, at, first = w.grams(n)
        hit = at[_repeated(keys ^ np.repeat(own, np.diff(first)))]
        cover = np.zeros(len(w.start) + 1, np.int64)
        cover[hit] += 1
        cover[hit + n] -= 1
        inside = np.cumsum(cover[:-1]) > 0
        out[f"repeat_chars_{n}"] = _sums(np.where(inside, size, 0), w.first)
        if n == _WINDOW:
            out["n_repeat_words"] = _sums(inside, w.first)
    return out


def _measured(lengths: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch.column(batch.num_columns - 1)):
                found = measure(w, lengths)
                kept = [batch.column(i).slice(w.row, w.rows) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *[pa.array(found[n].astype(np.int64)) for n in names]], names=[*batch.schema.names[:-1], *names])

    return run


def quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", carry: list[str] | None = None,
            coverage: dict[int, float] | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, the columns of ``carry``, the counts, ``base_failed`` and ``kept``.

    Words are runs of bytes other than space and 0x09-0x0D. Base: fewer than 20 words, or more than 30 % of the words in
    8-word windows that occur twice or more in the text. Verdict: characters of words inside repeated n-grams of each
    length of ``coverage`` (every occurrence counts) against its share of all word characters; characters of lines equal
    to an earlier line; symbols per word. Null, empty and blank texts have zero words and fail. Rows are independent:
    repeated rows give repeated results and null ids stay null. Result columns replace carried ones of the same
    name.
    """
    coverage = coverage or COVERAGE
    lengths = sorted({*coverage, _WINDOW})
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *[f"repeat_chars_{n}" for n in lengths]]
    carry = [c for c in carry or [] if c not in {*names, "doc_id", "base_failed", "kept"}]
    source = docs.select(F.col(id_column).alias("_id"), *[F.col(f"`{c}`").alias(f"_c{k}") for k, c in enumerate(carry)], F.col(text_column).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    out = source.mapInArrow(_measured(lengths, names), kinds + "".join(f", {n} long" for n in names))
    out = out.select(F.col("_id").alias("doc_id"), *[F.col(f"_c{k}").alias(c) for k, c in enumerate(carry)], *names)
    bad = F.col("dup_line_chars") > LINES * F.col("word_chars")
    for n, share in coverage.items():
        bad = bad | (F.col(f"repeat_chars_{n}") > share * F.col("word_chars"))
    bad = bad | (F.col("n_symbols") > SYMBOLS * F.col("n_words"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~bad)
