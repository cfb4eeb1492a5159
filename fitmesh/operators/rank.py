"""Exact global ranks without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitmesh.session import durable

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def ordered_rank(df: DataFrame, order: Sequence[str | Column], out: str = "rank", partitions: int | None = None) -> DataFrame:
    """0-based rank under ``order``, which should end in a unique key.

    One range exchange over the whole order (ties in the leading column are
    split by the key, so a hot value does not make a hot partition), a sort
    inside each partition, and per-partition offsets. The exchange is written
    once so that counts and ranks see the same partitions after executor loss.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = durable(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftright("_slot", _ROW_BITS)
    offsets, total = [], 0
    for r in sorted(placed.groupBy(part.alias("p")).count().collect(), key=lambda r: r["p"]):
        offsets.append((r["p"], total))
        total += r["count"]
    if not offsets:
        return placed.withColumn(out, F.lit(None).cast("bigint")).drop("_slot")
    # one row per partition of the exchange: bounded by its partition count
    table = df.sparkSession.createDataFrame(offsets, "_part long, _offset long")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(table), "_part")
        .withColumn(out, F.col("_offset") + F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_part", "_offset", "_slot")
    )


def from_files(df: DataFrame) -> bool:
    """True for a file scan, whose rows can be named by file and offset."""
    try:
        df.select("_metadata.file_path", "_metadata.file_block_start").schema
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            return False
        raise
    return True


def row_positions(df: DataFrame, out: str = "position") -> DataFrame:
    """0-based position of each row in file order (path, then offset in the file), without a shuffle of rows.

    Other tables have no lasting order: theirs is the one of the partitions when they are first read. It is written to the
    checkpoint folder with the rows, so that later reads, retries and lost executors see the same positions.
    """
    if from_files(df):
        base = df.withColumns({
            "_file": F.col("_metadata.file_path"),
            "_start": F.col("_metadata.file_block_start"),
            "_slot": F.monotonically_increasing_id(),
        })
    else:
        base = durable(df.withColumn("_slot", F.monotonically_increasing_id())).withColumns({
            "_file": F.lit(""), "_start": F.shiftright("_slot", _ROW_BITS)})
    blocks = sorted(
        base.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("n"), F.min("_slot").alias("first")).collect(),
        key=lambda r: (r["_file"], r["_start"]),
    )
    offsets, total = [], 0
    for b in blocks:
        offsets.append((b["_file"], b["_start"], total - b["first"]))
        total += b["n"]
    if not offsets:
        return df.withColumn(out, F.lit(None).cast("bigint"))
    # one row per input split; Spark picks the join strategy from its size
    table = df.sparkSession.createDataFrame(offsets, "_file string, _start long, _offset long")
    return base.join(table, ["_file", "_start"]).withColumn(out, F.col("_slot") + F.col("_offset")).drop(
        "_file", "_start", "_slot", "_offset")
