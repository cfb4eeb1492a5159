"""Benchmark decontamination: n-gram seeds find passages, Smith-Waterman alignment scores them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.llm.words import Words, words

BLOCK_WORDS = 1 << 18  # words of test items handled at once; more items take more blocks
MATCH, MISMATCH, GAP = 2, -1, -1
_FILTER_BITS = 22
_ENTRIES = 1 << 20  # pairs of a hit and a place in an item that are handled at once


class Items:
    """Words and seeds of one block of test items: every n-gram of an item is a seed."""

    def __init__(self, ids: list[int], texts: list[str], n: int):
        self.ids, self.n = np.array(ids, np.int64), n
        self.words: list[np.ndarray] = []
        grams = []
        for w in words(pa.array(texts, pa.string()), lower=True):
            g, _, first = w.grams(n)
            self.words += np.split(w.hash, w.first[1:-1])
            grams += np.split(g, first[1:-1])
        seeds = np.concatenate([*grams, np.zeros(0, np.uint64)])
        size = np.array([len(g) for g in grams], np.int64)
        item = np.repeat(np.arange(len(grams)), size)
        inside = np.arange(len(seeds)) - np.repeat(np.cumsum(size) - size, size)
        self.keys, key = np.unique(seeds, return_inverse=True)
        order = np.lexsort((inside, item, key))
        self.item, self.inside = item[order], inside[order]
        self.place = key[order] * len(self.ids) + self.item  # ascending: the places of one seed in a range of items are a slice
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of grams that are keys, and which key."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.filter[grams >> np.uint64(64 - _FILTER_BITS)])
        at = np.minimum(np.searchsorted(self.keys, grams[maybe]), len(self.keys) - 1)
        real = self.keys[at] == grams[maybe]
        return maybe[real], at[real]

    def entries(self, row: np.ndarray, key: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Hits with their places: a slice of the hits, the first place of each and how many. A row and an item meet in one part only."""
        todo = [(0, len(row), 0, len(self.ids))] if len(row) else []
        while todo:
            a, b, low, high = todo.pop()
            begin, end = (np.searchsorted(self.place, key[a:b] * len(self.ids) + i) for i in (low, high))
            middle = row[(a + b) // 2]
            cut = int(np.searchsorted(row, middle)) if row[a] < middle else int(np.searchsorted(row, middle, "right"))
            total = (end - begin).sum()
            if total <= _ENTRIES or (cut >= b and high - low == 1):
                if total:
                    yield slice(a, b), begin, end - begin
            elif cut < b:
                todo += [(a, cut, low, high), (cut, b, low, high)]
            else:
                todo += [(a, b, low, (low + high) // 2), (a, b, (low + high) // 2, high)]


def align(item: np.ndarray, text: np.ndarray) -> int:
    """Best local alignment of two word sequences, linear gaps."""
    best, step = 0, np.arange(len(text) + 1) * -GAP
    row = np.zeros(len(text) + 1, np.int64)
    for word in item:
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(text == word, MATCH, MISMATCH))
        new = np.maximum(np.maximum.accumulate(new + step) - step, 0)  # gaps in the item
        best = max(best, int(new.max()))
        row = new
    return best


def _matches(w: Words, items: Items, share: float) -> dict[int, tuple[float, int, int]]:
    """Row to (best score, item id, number of items that match)."""
    g, at_word, first = w.grams(items.n)
    at, key = items.hits(g)
    out: dict[int, tuple[float, int, int]] = {}
    rows = np.searchsorted(first, at, "right") - 1
    for part, start, count in items.entries(rows, key):
        entry = np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        item, row = items.item[entry], np.repeat(rows[part], count)
        begin = np.repeat(at_word[at[part]], count) - items.inside[entry]
        order = np.lexsort((begin, item, row))
        _score(w, items, share, row[order], item[order], begin[order], out)
    return out


def _score(w: Words, items: Items, share: float, row: np.ndarray, item: np.ndarray, begin: np.ndarray, out: dict[int, tuple[float, int, int]]) -> None:
    """Adds to ``out`` the alignments around sorted hits; ``begin`` is where the item would begin."""
    cuts = np.flatnonzero((np.diff(item) != 0) | (np.diff(row) != 0)) + 1
    for a, b in zip(np.append(0, cuts), np.append(cuts, len(item))):
        i, r = int(item[a]), int(row[a])
        own, most = items.words[i], 0
        pad = int(2 * len(own) * (1 - share)) + 1  # more gaps leave less than the share, whatever matches
        low, high = w.first[r], w.first[r + 1]
        k = a
        while k < b:
            lo, hi = begin[k] - pad, begin[k] + len(own) + pad
            while k + 1 < b and begin[k + 1] - pad <= hi:
                k += 1
                hi = begin[k] + len(own) + pad
            text = w.hash[max(low, lo) : min(high, hi)]
            # no alignment exceeds MATCH times the item's words that occur at all
            if MATCH * np.isin(own, text).sum() >= share * MATCH * len(own):
                most = max(most, align(own, text))
            k += 1
        score = most / (MATCH * len(own))
        if score >= share:
            best = out.get(r, (0.0, 0, 0))
            one = (score, int(items.ids[i]))
            if (-one[0], one[1]) < (-best[0], best[1]):
                out[r] = (*one, best[2] + 1)
            else:
                out[r] = (best[0], best[1], best[2] + 1)


def _aligned(items: Items, share: float):
    """Columns: any, then text, item, score, n_items. Results of earlier blocks are kept when they are better."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.num_columns - 4
            item, score, number = (batch.column(k + j).to_pylist() for j in (1, 2, 3))
            for w in words(batch.column(k), lower=True):
                for r, (s, i, n) in _matches(w, items, share).items():
                    r += w.row
                    number[r] += n
                    if item[r] is None or (-s, i) < (-score[r], item[r]):
                        item[r], score[r] = i, s
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: k + 1], pa.array(item, pa.int64()), pa.array(score, pa.float64()), pa.array(number, pa.int64())], names=batch.schema.names)

    return run


def decontaminate(docs: DataFrame, items: DataFrame, text_column: str = "text", item_id: str = "item_id", item_text: str = "text",
                  share: float = 0.5, n: int = 3) -> DataFrame:
    """All rows and columns of ``docs`` plus ``item_id, score, n_items, kept``.

    ``score`` is the best Smith-Waterman score (words, A-Z lower-cased; match 2, mismatch and gap -1) of a test item
    inside the text over the score of a whole copy. Items with at least ``share`` match; the best one (smallest id on
    ties) is named, ``n_items`` counts them, and matching documents are not kept. Every n-gram of an item is a seed and
    every hit is aligned, so any item of which ``n`` words in a row are left in the text is found. An item that matches
    without ``n`` common words in a row (say, one word in each ``n`` changed) is not.

    Items are taken in blocks of about ``BLOCK_WORDS`` words, every block against all rows. Null or empty texts match
    nothing. Items with fewer than ``n`` words, null texts or null ids cannot match; repeated items are repeated matches.
    Rows of ``docs`` are independent. Result columns replace columns of the same name.
    """
    names = ["item_id", "score", "n_items"]
    columns = [c for c in docs.columns if c not in {*names, "kept"}]
    usable = items.where(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t"))
    total = usable.agg(F.sum(F.size(F.split("t", r"[\x20\x09-\x0D]+")))).first()[0] or 0
    blocks = int(total // BLOCK_WORDS) + 1
    work = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)], F.col(f"`{text_column}`").alias("_text"),
                       F.lit(None).cast("long").alias("_item"), F.lit(0.0).alias("_score"), F.lit(0).cast("long").alias("_number"))
    for k in range(blocks):
        rows = usable.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).orderBy("i", "t").collect()  # one block
        if not rows:
            continue
        block = Items([r["i"] for r in rows], [r["t"] for r in rows], n)
        work = work.mapInArrow(_aligned(block, share), work.schema)
    out = work.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)], F.col("_item").alias("item_id"), F.col("_score").alias("score"),
                      F.col("_number").alias("n_items"))
    return out.withColumn("kept", F.col("n_items") == 0)
