"""Balanced label propagation: linked documents move towards one shard while shards keep equal bytes. DataFrames only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fitmesh.llm.storage import stored

_BUCKETS = 4096  # ranges of the order hash whose sums are kept per shard
_RANGE = 1 << 32
_REPEATS = 1 << 16  # repeats of one row that are numbered at once


def _bucket(h: Column, buckets: int) -> Column:
    return F.shiftright(h, 32 - (buckets - 1).bit_length()).cast("int") if buckets > 1 else F.lit(0)


def running(df: DataFrame, by: str, value: Column, buckets: int, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over the rows of the same ``by`` that come before in the order of ``h`` and ``u``.

    Rows are summed within ranges of the hash, ranges are summed in a small table, so no task holds a whole shard.
    """
    rows = df.withColumn("_v", value).withColumn("_b", _bucket(F.col("h"), buckets))
    sums = rows.groupBy(by, "_b").agg(F.sum("_v").alias("_s"))
    before = Window.partitionBy(by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(by, "_b", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy(by, "_b").orderBy("h", "u").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn(name, F.sum("_v").over(inside) - F.col("_v"))
    return local.join(offsets, [by, "_b"]).withColumn(name, (F.col(name) + F.col("_o")).cast("long")).drop("_v", "_b", "_o")


def _loads(spark, df: DataFrame, shards: int, column: str) -> DataFrame:
    """One row per shard with its bytes; ``shards`` rows."""
    empty = spark.range(shards).select(F.col("id").cast("int").alias(column))
    return empty.join(df.groupBy(column).agg(F.sum("size").alias("load")), column, "left").select(column, F.coalesce("load", F.lit(0)).alias("load"))


def _one_each(rows: DataFrame) -> DataFrame:
    """``rows`` with ``u``, a hash that tells repeated rows apart by a number and depends on nothing but the rows."""
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    part = counted.withColumn("_k", F.explode(F.expr(f"sequence(0L, (_n - 1) div {_REPEATS})")))
    each = part.withColumn("_r", F.explode(F.expr(f"sequence(_k * {_REPEATS}, least(_n, (_k + 1) * {_REPEATS}) - 1)")))
    return each.withColumn("u", F.xxhash64(*rows.columns, "_r")).drop("_n", "_k", "_r")


def assign_shards(docs: DataFrame, shards: int = 40, rounds: int = 4, slack: float = 0.25, id_column: str = "doc_id",
                  text_column: str = "text", group_column: str | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row. Law: bytes.

    Documents start in a shard by hash. Each round, every group of linked documents (equal texts, or equal values of
    ``group_column``) looks at the bytes it has in each shard; members elsewhere ask for the shard with most of them (ties by hash), and
    are let in by hash order while the shard is below its quota (the mean plus ``slack``: wide, as the last step evens out). At the end shards above the
    mean give documents, ungrouped ones first, to shards below it, along one line of bytes: every shard ends within about
    one document of the mean. A group larger than the free room is split. ``size`` is UTF-8 bytes plus 16 (null: 16).
    ``slot`` counts from 0 within a shard. ``grown_shard`` is null under this law.

    The result depends on the rows only, not on their partitions or order. Null ids and repeated rows are rows like any others and get slots of their own. An empty table gives no rows.
    """
    if group_column is not None and docs.schema[group_column].dataType.simpleString() != "string":
        docs = docs.withColumn(group_column, F.col(group_column).cast("string"))
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    group = F.xxhash64(text) if group_column is None else F.xxhash64(group_column)
    rows = docs.select(
        F.col(id_column).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), group.alias("g"))
    rows = _one_each(rows)
    rows = stored(rows.withColumn("h", F.shiftrightunsigned(F.xxhash64("u", F.lit(1)), 32)), "shard-rows")
    total, n, largest = rows.agg(F.sum("size"), F.count(F.lit(1)), F.max("size")).first()
    total = total or 0
    state = rows.withColumn("shard", F.pmod(F.xxhash64("u", F.lit(2)), F.lit(shards)).cast("int"))
    grouped = rows.groupBy("g").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("g")
    linked = stored(state.join(grouped, "g", "left_semi"), "shard-linked")
    single = _loads(spark, state.join(grouped, "g", "left_anti"), shards, "shard").withColumnRenamed("load", "fixed")
    single = stored(single, "shard-single")
    quota = int(total / shards * (1 + slack)) + 1
    for _ in range(rounds):
        held = linked.groupBy("g", "shard").agg(F.sum("size").alias("w"))
        best = held.groupBy("g").agg(F.max(F.struct("w", F.xxhash64("g", "shard").alias("t"), "shard")).alias("m")).select("g", F.col("m")["shard"].alias("want"))
        asked = linked.join(best, "g")
        movers = asked.where("shard <> want").withColumn("_b", _bucket(F.col("h"), _BUCKETS))
        wanted = movers.groupBy("want", "_b").agg(F.sum("size").alias("s"))
        upto = Window.partitionBy("want").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        load = _loads(spark, linked, shards, "shard").join(single, "shard").select(F.col("shard").alias("want"), (F.lit(quota) - F.col("load") - F.col("fixed")).alias("room"))
        cut = wanted.withColumn("s", F.sum("s").over(upto)).join(load, "want").where("s <= room").groupBy("want").agg(F.max("_b").alias("cut"))
        moved = asked.join(F.broadcast(cut), "want", "left")  # one row per shard
        goes = F.coalesce(_bucket(F.col("h"), _BUCKETS) <= F.col("cut"), F.lit(False)) & (F.col("shard") != F.col("want"))
        linked = stored(moved.withColumn("shard", F.when(goes, F.col("want")).otherwise(F.col("shard"))).select(*linked.columns), "shard-linked")
    free = state.join(grouped, "g", "left_anti").withColumn("tied", F.lit(0))
    every = stored(free.unionByName(linked.withColumn("tied", F.lit(1))), "shard-state")
    # even out: of each shard above the mean, the last documents in the order (tied, h) beyond the mean leave
    mean = total / shards
    buckets = 1
    while buckets * 50_000 * shards < n and buckets < 1 << 20:
        buckets *= 2
    every = every.withColumn("h", F.col("h").bitwiseAND(F.lit(_RANGE // 2 - 1)) + (1 - F.col("tied")) * F.lit(_RANGE // 2))
    placed = running(every, "shard", F.col("size"), buckets, "below")
    # a document whose end passes the mean leaves if that brings the shard nearer to it
    placed = stored(placed.withColumn("leaves", F.col("below") + F.col("size") / 2 > F.lit(mean)), "shard-placed")
    stay = _loads(spark, placed.where("not leaves"), shards, "shard")
    order = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    holes = stay.withColumn("hole", F.greatest(F.lit(mean) - F.col("load"), F.lit(0.0)))
    holes = holes.withColumn("from", F.coalesce(F.sum("hole").over(order), F.lit(0.0))).select(F.col("shard").alias("to"), "from", (F.col("from") + F.col("hole")).alias("until"))
    line = running(placed.where("leaves").withColumn("_all", F.lit(0)), "_all", F.col("size"), buckets, "at")
    middle = F.col("at") + F.col("size") / 2
    last = holes.where("until > from").agg(F.max("to").alias("last"))
    moved = line.join(F.broadcast(holes), (middle >= F.col("from")) & (middle < F.col("until")), "left").join(F.broadcast(last), how="left")
    moved = moved.withColumn("shard", F.coalesce("to", "last", "shard"))
    columns = ["doc_id", "size", "text_crc32", "u", "h", "shard"]
    final = stored(placed.where("not leaves").select(columns).unionByName(moved.select(columns)), "shard-final")
    out = running(final.withColumn("h", F.shiftrightunsigned(F.xxhash64("u", F.lit(1)), 32)), "shard", F.lit(1), buckets, "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
