"""MinHash near-duplicates with tensored banding.

Two small collections of ``bands`` sub-keys (``rows`` minhashes each) are computed per text; a table key is a pair of one
sub-key from either, so ``bands**2`` tables cost ``2 * bands * rows`` minhashes. A pair of texts at similarity s meets in
some table with probability ``(1 - (1 - s**rows)**bands)**2``: 0.9999 at s = 0.8 with the defaults, more above.
Candidates are verified on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.llm.graph import components
from fitmesh.llm.storage import stored
from fitmesh.llm.words import Words, mix, slices, text_buffers, words

_BITS = 42
_SLICE = 1 << 19  # bytes of texts whose shingles are hashed at once


def shingle_hashes(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's n-word shingles (repeats included) and where each row's begin; a short text is one shingle."""
    grams, _, first = w.grams(n)
    count = np.diff(w.first)
    for k in np.unique(count[(count > 0) & (count < n)]):
        short, _, at = w.grams(int(k))
        rows = np.flatnonzero(count == k)
        grams = np.insert(grams, first[rows], short[at[rows]])
        extra = np.zeros(len(count), np.int64)
        extra[rows] = 1
        first = first + np.concatenate([[0], np.cumsum(extra)])
    return grams, first


def _signatures(n: int, bands: int, rows: int):
    total = 2 * bands * rows
    draw = np.random.default_rng(7)
    factor = draw.integers(1, 2**63, total, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    salt = draw.integers(1, 2**63, total, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for w in words(batch.column(1), lower=True, limit=_SLICE):
                grams, first = shingle_hashes(w, n)
                size, f0, f1 = (np.zeros(w.rows, np.uint64) for _ in range(3))
                full = np.flatnonzero(np.diff(first))
                for r in full:
                    own = np.unique(grams[first[r] : first[r + 1]])
                    size[r], f0[r], f1[r] = len(own), own.sum(), mix(own + np.uint64(1)).sum()
                least = np.zeros((total, w.rows), np.uint64)
                if len(full):
                    for k in range(total):
                        least[k, full] = np.minimum.reduceat((grams ^ salt[k]) * factor[k], first[full])
                spread = mix(least)
                sub = spread.reshape(2 * bands, rows, w.rows)
                keys = np.arange(1, 2 * bands + 1, dtype=np.uint64)[:, None] * np.uint64(0x632BE59BD9B4E019)
                for k in range(rows):
                    keys = mix(keys + sub[:, k])
                bits = spread & np.uint64(1)
                shift = np.arange(_BITS, dtype=np.uint64)[:, None]
                half = min(_BITS, total // 2)
                sketch = [(bits[p : p + half] << shift[:half]).sum(0, dtype=np.uint64) for p in (0, total // 2)]
                lists = lambda x: pa.ListArray.from_arrays(
                    pa.array(np.arange(0, w.rows * bands + 1, bands, dtype=np.int32)), pa.array(np.ascontiguousarray(x.T).view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(w.row, w.rows), pa.array(size.view(np.int64)), pa.array(f0.view(np.int64)), pa.array(f1.view(np.int64)),
                     lists(keys[:bands]), lists(keys[bands:]), *[pa.array(s.view(np.int64)) for s in sketch]],
                    names=["id", "n", "f0", "f1", "a", "b", "s0", "s1"])

    return run


def _sets(n: int):
    """Distinct shingle hashes, ascending, packed, of rows whose set is the one announced. Columns: pid, text, n, f0, f1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, f0, f1 = (batch.column(k).to_numpy().view(np.uint64) for k in (2, 3, 4))
            for w in words(batch.column(1), lower=True, limit=_SLICE):
                grams, first = shingle_hashes(w, n)
                ids, packed = [], []
                for r in range(w.rows):
                    own, at = np.unique(grams[first[r] : first[r + 1]]), w.row + r
                    if len(own) == size[at] and own.sum() == f0[at] and mix(own + np.uint64(1)).sum() == f1[at]:
                        ids.append(batch.column(0)[at].as_py())
                        packed.append(own.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary())], names=["id", "shingles"])

    return run


def _verified(percent: int):
    """Pairs whose full shingle sets have at least ``percent`` % of their union in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, shingle`` of packed sets, and the integers that follow them."""
    for batch in batches:
        data, offsets = text_buffers(batch.column(1))
        more = batch.schema.names[2:]
        for i, j in slices(offsets):
            part = data[offsets[i] : offsets[j]]
            times = np.diff(offsets[i : j + 1]) // 8
            ids, *rest = (pa.array(np.repeat(batch.column(c).slice(i, j - i).to_numpy(), times)) for c in ("id", *more))
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.frombuffer(part.tobytes(), np.int64)), *rest], names=["id", "shingle", *more])


def _undecided(sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: all pairs of sets of different components ``c`` that may have ``percent`` % of their union in common.

    Shingles that only one component has are common to no pair. Of the others, rarest first, two linked sets share one among
    the first ``m - need + 1`` of either: ``m`` is their number and ``need`` the least that a link must have in common.
    """
    need = F.floor((F.lit(percent) * F.col("n") + 99) / 100)
    long = stored(sets.select("id", "shingles", "c", "n").mapInArrow(_shingles, "id long, shingle long, c long, n long"), "rest")
    common = long.groupBy("shingle").agg(F.count(F.lit(1)).alias("x"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1")
    own = long.join(common.select("shingle", "x"), "shingle").groupBy("id").agg(
        F.first("c").alias("c"), F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("x", "shingle"))).alias("s"))
    own = own.withColumn("m", F.size("s")).where(F.col("m") >= need)
    own = own.select("id", "c", "n", "m", F.posexplode(F.slice("s", F.lit(1), (F.col("m") - need + 1).cast("int"))).alias("at", "e"))
    own = stored(own.select("id", "c", "n", (F.col("m") - F.col("at")).alias("left"), F.col("e.shingle").alias("shingle")), "prefixes")
    other = own.select("shingle", *[F.col(c).alias(f"o_{c}") for c in ("id", "c", "n", "left")])
    size = lambda both: 100 * both >= percent * (F.col("n") + F.col("o_n") - both)
    # at the first shingle that two sets share, no more than the shingles from there on can be common
    return own.join(other, "shingle").where((F.col("id") < F.col("o_id")) & (F.col("c") != F.col("o_c")) & size(F.least("left", "o_left"))).select(
        F.col("id").alias("a"), F.col("o_id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 5, percent: int = 80,
                    bands: int = 14, rows: int = 3, rounds: int = 3, exact: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Texts are linked when their sets of ``shingle``-word shingles (A-Z lower-cased) have at least ``percent`` % of the
    union in common; components of links share the smallest id, and that document is kept. A text with fewer words is one
    shingle. Null, empty and blank texts have no shingle and stand alone. Equal sets collapse before any search, so
    copies cost nothing. Rows that repeat an id are one node of the graph: each gets the component of all its texts.
    A null id stands alone: its component is null and it is kept. Ids are integers. Other columns are ignored.

    Candidates are the documents of a table key, taken leader by leader: one document of each key is put against all others
    of the key outside its component and then leaves the key, since all its pairs are decided; a key closes when its
    documents are one component. A round has at most as many pairs as keys have documents. The first leaders are the
    smallest ids, the second those with the smallest share of shingles that no other open document has (the least edited:
    in a group of edited copies whatever can link to any copy links to it), then those of the smallest components.
    Rounds go on while they join components, and for ``rounds`` rounds at least. Documents of the keys that are open then are
    joined exactly, by the rarest of their shingles: each of their pairs is decided. ``exact`` goes on with rounds instead until
    every key is closed or decided, as many as the largest key has documents that link to nothing. Pairs of the rounds are set aside before verification by size and by the number of shingles
    that no other open document has (exact bounds), and by one-bit sketches (probabilistic, as the banding is).
    """
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    sig = stored(source.mapInArrow(
        _signatures(shingle, bands, rows), "id long, n long, f0 long, f1 long, a array<long>, b array<long>, s0 long, s1 long"), "signatures")
    known = sig.where("n > 0 and id is not null")
    # the search is over classes of equal sets, each under a number of its own: an id may have several texts
    classes = stored(known.groupBy("n", "f0", "f1").agg(F.min("id").alias("rep")).withColumn("pid", F.monotonically_increasing_id()), "classes")
    same = known.join(classes, ["n", "f0", "f1"]).where("id = rep").dropDuplicates(["pid"])
    reps = same.select(F.col("pid").alias("id"), "n", "a", "b", "s0", "s1")
    subs = reps.select("id", F.explode(F.concat("a", "b")).alias("sub"))
    repeated = subs.groupBy("sub").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("sub")
    found = subs.join(repeated, "sub", "left_semi").groupBy("id").agg(F.collect_set("sub").alias("subs"))
    pick = lambda side: F.array_intersect(side, "subs")
    combined = reps.join(found, "id").select("id", "n", "s0", "s1", pick("a").alias("a"), pick("b").alias("b"))
    combined = combined.select("id", "n", "s0", "s1", F.explode("a").alias("x"), "b").select("id", "n", "s0", "s1", "x", F.explode("b").alias("y"))
    keyed = stored(combined.select(F.xxhash64("x", "y").alias("key"), "id", "n", "s0", "s1"), "keys")
    shared = keyed.groupBy("key").agg(F.min("id").alias("i0"), F.max("id").alias("i1")).where("i0 < i1").select("key")
    members = stored(keyed.join(shared, "key", "left_semi"), "members")
    able = members.select("id").distinct()
    wanted = classes.join(able.withColumnRenamed("id", "pid"), "pid", "left_semi").withColumnRenamed("rep", "id")
    sets = source.join(wanted, "id").select("pid", "text", "n", "f0", "f1").mapInArrow(_sets(shingle), "id long, shingles binary")
    sets = stored(sets.groupBy("id").agg(F.first("shingles").alias("shingles")), "sets")  # repeated rows are one

    def verify(pairs: DataFrame) -> DataFrame:
        ab = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
        ab = ab.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
        return ab.mapInArrow(_verified(percent), "a long, b long")

    def able_pair(p: str, q: str):
        """Sizes, shingles that others have, and sketches allow the similarity."""
        bits = F.bit_count(F.col(f"{p}s0").bitwiseXOR(F.col(f"{q}s0"))) + F.bit_count(F.col(f"{p}s1").bitwiseXOR(F.col(f"{q}s1")))
        common = F.least(f"{p}m", f"{q}m")
        size = 100 * common >= percent * (F.col(f"{p}n") + F.col(f"{q}n") - common)
        # about two sketch bits in ten differ where minhashes agree in `percent` % of cases; twice as many plus 8 is beyond chance
        return size & (bits <= 8 + 2 * _BITS * (100 - percent) // 100)

    def merged(got: DataFrame, labels: DataFrame) -> DataFrame:
        ends = got.join(labels.select(F.col("id").alias("a"), F.col("c").alias("x")), "a").join(labels.select(F.col("id").alias("b"), F.col("c").alias("y")), "b")
        comp = components(ends, "x", "y").withColumnsRenamed({"node": "c", "component": "new"})
        return stored(labels.join(comp, "c", "left").select("id", F.coalesce("new", "c").alias("c")), "labels")

    labels = able.select("id", F.col("id").alias("c"))
    now, done = members.withColumn("m", F.col("n")), 0
    while True:
        sized = labels if done < 2 else labels.join(labels.groupBy("c").agg(F.count(F.lit(1)).alias("k")), "c")
        now = now.drop("c", "k").join(sized, "id")
        order = [F.col("id"), (F.col("n") - F.col("m")) / F.col("n"), F.col("k") if done > 1 else None][min(done, 2)]
        rank = F.struct(order.alias("o"), (F.xxhash64("id", F.lit(done)) if done else F.col("id")).alias("h"))
        carry = ["id", "n", "s0", "s1", "m", "c"]
        leads = now.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.min_by(F.struct(*carry), rank).alias("l")).where("c0 < c1")
        led = now.join(leads.select("key", *[F.col(f"l.{c}").alias(f"l_{c}") for c in carry]), "key")
        now = stored(led.where("id <> l_id").select(*now.columns, *[f"l_{c}" for c in carry]), "open")  # closed keys and leaders are gone
        pairs = now.where((F.col("c") != F.col("l_c")) & able_pair("", "l_")).select(F.least("id", "l_id").alias("a"), F.greatest("id", "l_id").alias("b")).distinct()
        got = stored(verify(pairs), "links")
        joined = not got.isEmpty()
        if joined:
            labels = merged(got, labels)
        done += 1
        now = now.drop(*[f"l_{c}" for c in carry])
        if done == 1:
            # only n - u shingles of a document are in any other open document: at most that many are common to a pair
            still = now.select("id").distinct()
            alone = sets.join(still, "id", "left_semi").mapInArrow(_shingles, "id long, shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("x"), F.min("id").alias("id"))
            alone = alone.where("x = 1").groupBy("id").agg(F.count(F.lit(1)).alias("u"))
            now = now.drop("m").join(alone, "id", "left").withColumn("m", F.col("n") - F.coalesce("u", F.lit(0))).where(100 * F.col("m") >= percent * F.col("n")).drop("u")
        elif now.isEmpty():
            break
        elif done >= rounds and not joined and not exact:
            rest = now.select("id", "n").distinct().join(labels.select("id", "c"), "id").join(sets, "id")
            got = stored(verify(_undecided(rest, percent)), "links")
            labels = labels if got.isEmpty() else merged(got, labels)
            break
    rep = lambda side: classes.select(F.col("pid").alias(side), F.col("rep").alias(f"rep_{side}"))
    linked = labels.join(labels.where("id <> c").select("c").distinct(), "c", "left_semi").join(rep("id"), "id")
    least = linked.groupBy("c").agg(F.min("rep_id").alias("b"))
    edges = linked.join(least, "c").where("rep_id <> b").select(F.col("rep_id").alias("a"), "b")  # stars around the smallest ids
    # every text of an id is an edge from the id to its class
    several = known.groupBy("id").agg(F.min(F.struct("n", "f0", "f1")).alias("x"), F.max(F.struct("n", "f0", "f1")).alias("y")).where("x <> y").select(F.col("id").alias("a"))
    own = known.join(classes, ["n", "f0", "f1"]).where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    comp = components(edges.unionAll(own.join(several, "a", "left_semi"))).withColumnRenamed("node", "rep")
    out = sig.join(classes, ["n", "f0", "f1"], "left").join(comp, "rep", "left")
    component = F.when(F.col("n") > 0, F.coalesce("component", "rep", "id")).otherwise(F.col("id"))
    out = out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
