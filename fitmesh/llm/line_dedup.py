"""Repeated runs of lines, found by winnowing over line hashes. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fitmesh.llm.storage import stored

_SPACE = r"[\x20\x09-\x0D]+"


def _lines(text):
    return F.split(text, "\n", -1)


def line_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = 50) -> DataFrame:
    """All columns of ``docs`` with the text's later repeated runs deleted, plus ``n_lines``, ``n_removed``.

    The line sequence of a document is its lines (split at \\n) that hold a word, outer spaces ignored. A run is deleted
    where a run of equal lines with at least ``min_words`` words stands earlier: in a document with a smaller id (nulls
    first; on equal ids, smaller text hash), or further up in the same document. Runs that
    overlap are deleted as one; what stands first anywhere stays. Blank lines are never counted or deleted unless every
    other line of the document goes.

    A window is the shortest stretch of lines from a line forwards, or backwards, with ``min_words`` words. The smallest
    line hash of each window is its fingerprint, so any two copies of a run hold an equal fingerprint. Windows whose
    fingerprint position is shared by no other window position cannot repeat and end there; the others are matched as
    wholes with the first window of equal lines. Forward windows extend a match to its first line and
    backward windows to its last. Every step is a sum or a join per fingerprint: no list of a fingerprint's places is made.

    Null texts stay null (no lines), empty ones stay empty. Rows that repeat id and text are one document and keep the
    same result. Very long documents are one sort group each; only hashes are sorted. Columns of any name keep their
    values; only ``n_lines`` and ``n_removed`` are replaced.
    """
    columns = [c for c in docs.columns if c not in {"n_lines", "n_removed"}]
    text = F.col(f"`{text_column}`")
    source = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns)], F.col(f"`{id_column}`").alias("id"), text.alias("text"),
                         F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"))
    bare = source.select(F.col("id").alias("d"), F.col("th").alias("_th"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    bare = bare.withColumn("line", F.regexp_replace("line", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")).where("line <> ''")
    bare = bare.select("d", "_th", "pos", F.xxhash64("line").alias("h"), F.hash("line").alias("g"), F.size(F.split("line", _SPACE)).cast("long").alias("words"))
    once = Window.partitionBy("d", "_th", "pos").orderBy("h")
    bare = bare.repartition("d", "_th").withColumn("_row", F.row_number().over(once)).where("_row = 1").drop("_row")
    upto = Window.partitionBy("d", "_th").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = bare.withColumn("c1", F.sum("words").over(upto)).withColumn("c0", F.col("c1") - F.col("words"))
    cells = F.struct("h", "g", "pos", "words")
    ahead = Window.partitionBy("d", "_th").orderBy("c0").rangeBetween(0, min_words - 1)
    behind = Window.partitionBy("d", "_th").orderBy("c1").rangeBetween(1 - min_words, 0)
    lines = lines.select("d", "_th", F.collect_list(cells).over(ahead).alias("f"), F.collect_list(cells).over(behind).alias("b"))
    # a line with many words may stand in both; equal stretches appear once
    spans = lines.select("d", "_th", F.explode(F.array("f", "b")).alias("w"))
    spans = spans.where(F.aggregate("w", F.lit(0).cast("long"), lambda s, x: s + x["words"]) >= min_words)
    least = F.array_min(F.transform("w", lambda x: F.struct(x["h"].alias("h"), x["pos"].alias("pos"))))
    spans = spans.select(
        "d", "_th", F.col("w")[0]["pos"].alias("lo"), F.element_at("w", -1)["pos"].alias("hi"), least.alias("m"),
        F.xxhash64("w.h").alias("k0"), F.hash("w.g").alias("k1"))
    spans = stored(spans.select("d", "_th", "lo", "hi", F.col("m")["h"].alias("print"), F.col("m")["pos"].alias("at"), "k0", "k1"), "windows")
    # both anti joins are keyed by place, so a print or window that stands everywhere is spread over all tasks
    spans = spans.withColumn("place", F.xxhash64("d", "_th", "at"))
    alone = spans.groupBy("print").agg(F.min("place").alias("place"), F.max("place").alias("p1")).where("place = p1").select("print", "place")
    open_spans = spans.join(alone, ["print", "place"], "left_anti").select("d", "_th", "lo", "hi", "k0", "k1")
    firsts = open_spans.groupBy("k0", "k1").agg(F.min(F.struct("d", "_th", "lo")).alias("f"))
    firsts = firsts.select("k0", "k1", F.col("f")["d"].alias("fd"), F.col("f")["_th"].alias("fth"), F.col("f")["lo"].alias("flo"))
    is_first = (open_spans["k0"] == firsts["k0"]) & (open_spans["k1"] == firsts["k1"]) & F.col("d").eqNullSafe(F.col("fd")) & (F.col("_th") == F.col("fth")) & (F.col("lo") == F.col("flo"))
    later = open_spans.join(firsts, is_first, "left_anti")
    gone = later.groupBy("d", "_th").agg(F.collect_set(F.struct("lo", "hi")).alias("gone"))
    out = source.join(gone, F.col("id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("_th")), "left").withColumn("parts", _lines(F.col("text")))
    real = lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))
    places = F.array_distinct(F.flatten(F.transform("gone", lambda r: F.sequence(r["lo"], r["hi"]))))
    out = out.withColumn("dead", F.filter(places, lambda i: real(F.col("parts")[i])))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "dead"), lambda i: F.col("parts")[i])
    out = out.withColumn("n_lines", F.coalesce(F.size(F.filter("parts", real)), F.lit(0)).cast("long"))
    out = out.withColumn("n_removed", F.coalesce(F.size("dead"), F.lit(0)).cast("long"))
    rest = F.when(F.col("n_removed") == F.col("n_lines"), F.lit("")).otherwise(F.array_join(left, "\n"))
    rest = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(rest)
    return out.select(*[(rest if c == text_column else F.col(f"c{k}")).alias(c) for k, c in enumerate(columns)], "n_lines", "n_removed")
