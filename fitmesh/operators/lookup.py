"""Lookup joins that stay whole and balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 << 20  # a lookup table up to this size is broadcast
HOT_SHARE = 0.001           # keys above this share of the rows are joined by broadcast: at most 1000 of them
_SPREAD = 4096


def row_size(fields: list[T.StructField]) -> Column:
    """Bytes of a row: 16 a column plus the contents of strings, binaries and arrays."""
    size = F.lit(16 * len(fields)).cast("bigint")
    for f in fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))) if not _flat(f.dataType) else 8 * F.size(c), F.lit(0))
        elif isinstance(f.dataType, T.StructType):
            size = size + F.octet_length(F.to_json(F.struct(c)))
    return size


def _flat(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.NumericType, T.BooleanType))


def keyed_lookup(df: DataFrame, table: DataFrame, key: str, count: str, table_bytes: int | None = None,
                 total: int | None = None, row_bytes: int | None = None) -> DataFrame:
    """Left join of ``table`` (unique ``key``; ``count`` = rows of ``df`` expected per key) onto ``df``.

    A table of few bytes is broadcast: they are summed over its rows unless given (``table_bytes``, or ``row_bytes``
    where all rows have the same known size). A large one is split: the few hot keys are broadcast, everything else is
    shuffled, and rows already served are spread over all partitions so that
    neither side of the join is skewed.
    """
    values = [c for c in table.columns if c not in (key, count)]
    if table_bytes is None and row_bytes is not None:
        table_bytes = table.count() * row_bytes
    elif table_bytes is None:
        sizes = table.agg(F.sum(row_size([f for f in table.schema.fields if f.name != count])).alias("b"), F.sum(count).alias("t")).first()
        table_bytes, total = sizes["b"] or 0, sizes["t"] if total is None else total
    if table_bytes <= BROADCAST_BYTES:
        return df.join(F.broadcast(table.drop(count)), key, "left")
    total = table.agg(F.sum(count)).first()[0] if total is None else total
    hot = F.col(count) > F.lit(HOT_SHARE) * F.lit(total)
    hot_side = table.filter(hot).select(F.col(key), F.struct(*values).alias("_hot"))
    cold_side = table.filter(~hot).select(F.col(key).alias("_key"), F.lit(0).alias("_spread"), F.struct(*values).alias("_cold"))
    staged = df.join(F.broadcast(hot_side), key, "left")
    served = F.col("_hot").isNotNull() | F.col(key).isNull()
    staged = staged.withColumns({
        "_key": F.when(~served, F.col(key)),
        "_spread": F.when(served, 1 + F.pmod(F.monotonically_increasing_id(), F.lit(_SPREAD))).otherwise(F.lit(0)).cast("int"),
    })
    joined = staged.join(cold_side, ["_key", "_spread"], "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns],
                         *[F.coalesce(F.col(f"_hot.{v}"), F.col(f"_cold.{v}")).alias(v) for v in values])

