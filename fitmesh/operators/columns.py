"""Column selection, projection, pairing and profiling."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fitmesh.operators.rank import row_positions

_KINDS = ("numeric", "categorical", "passthrough")


def kind_of(dtype: T.DataType) -> str:
    if isinstance(dtype, T.NumericType):
        return "numeric"
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return "categorical"
    return "passthrough"


def select_by_type(df: DataFrame, kind: str, exclude: Sequence[str] = ()) -> list[str]:
    """Column names of one kind in table order; booleans, dates and nested types are ``passthrough``."""
    if kind not in _KINDS:
        raise ValueError(f"kind must be one of {_KINDS}")
    return [f.name for f in df.schema.fields if f.name not in set(exclude) and kind_of(f.dataType) == kind]


def type_table(df: DataFrame) -> DataFrame:
    """``(position, column, kind)`` of every column; reads the schema only."""
    rows = [(i, f.name, kind_of(f.dataType)) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, kind string")


def interaction_names(columns: Sequence[str], k: int = 3) -> list[tuple[str, str, str]]:
    return [(f"{a}_x_{b}", a, b) for a, b in combinations(list(columns)[:k], 2)]


def interactions(df: DataFrame, k: int = 3, columns: Sequence[str] | None = None) -> DataFrame:
    """Products of all pairs among the first ``k`` numeric columns, named ``{a}_x_{b}``, in one projection."""
    columns = select_by_type(df, "numeric") if columns is None else columns
    made = {name: F.col(f"`{a}`") * F.col(f"`{b}`") for name, a, b in interaction_names(columns, k)}
    return df.withColumns(made) if made else df


def attach_components(df: DataFrame, vector: str, k: int, keep: Sequence[str] = (), prefix: str = "pc") -> DataFrame:
    """Kept columns first, then ``pc1..pck`` read out of the row's vector (no join)."""
    from fitmesh.functions.vectors import as_array

    x = as_array(df, vector)
    return df.select(*keep, *[x[i].alias(f"{prefix}{i + 1}") for i in range(k)])


def keep_inliers(df: DataFrame, mask: str = "is_inlier") -> DataFrame:
    """Whole rows (label included) whose mask is true."""
    return df.filter(F.col(mask)).drop(mask)


def split_target(df: DataFrame, column: str, label: str = "label") -> DataFrame:
    """The target column renamed to ``label``, beside all other columns."""
    if column not in df.columns:
        raise ValueError(f"no column {column!r}")
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != column], F.col(f"`{column}`").cast("double").alias(label))


def first_column_target(df: DataFrame, strict: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """The first column of a target table; ``strict`` refuses further columns."""
    candidates = [c for c in df.columns if c not in set(keep)]
    if strict and len(candidates) > 1:
        raise ValueError("Target file must contain a single target column.")
    return df.select(*keep, F.col(f"`{candidates[0]}`").cast("double").alias("label"))


def align_xy(x: DataFrame, y: DataFrame, key: Sequence[str] | None = None, check: bool = True) -> DataFrame:
    """Pair features with targets by ``key``, or by row position when there is none.

    ``check``: every key stands exactly once on either side, found in one aggregation over both; without a key, both
    sides have as many rows.
    """
    if key:
        joined = x.join(y, list(key), "inner")
        if check:
            sides = x.select(*key, F.lit(1).alias("_x"), F.lit(0).alias("_y")).unionAll(y.select(*key, F.lit(0).alias("_x"), F.lit(1).alias("_y")))
            per_key = sides.groupBy(*key).agg(F.sum("_x").alias("_x"), F.sum("_y").alias("_y"))
            wrong = (F.col("_x") != 1) | (F.col("_y") != 1) | reduce(or_, [F.col(k).isNull() for k in key])
            nx, ny, bad = per_key.agg(F.sum("_x"), F.sum("_y"), F.count_if(wrong)).first()
            if bad:
                raise ValueError(f"features have {nx or 0} rows, target {ny or 0}; {bad} keys are null, repeated or on one side only")
        return joined
    if check:
        nx, ny = x.count(), y.count()
        if nx != ny:
            raise ValueError(f"features have {nx} rows, target {ny}")
    left, right = row_positions(x, "_position"), row_positions(y, "_position")
    return left.join(right, "_position", "inner").drop("_position")


_LONG_VALUE = 64  # longer values are told apart by their SHA-256


def _identity(name: str, dtype: T.DataType):
    """A short string that differs for different values: -0.0 is 0.0, NaN is one value, maps in another order differ."""
    c = F.col(f"`{name}`")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = (c + F.lit(0.0).cast(dtype)).cast("string")
    elif isinstance(dtype, T.BinaryType):
        text = F.hex(c)
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(F.struct(c.alias("v")), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"})
    else:
        text = c.cast("string")
    short = F.when(F.length(text) <= _LONG_VALUE, F.concat(F.lit("="), text)).otherwise(F.sha2(text, 256))
    return F.when(c.isNotNull(), short)


def distinct_counts(df: DataFrame) -> DataFrame:
    """``(position, n_distinct)`` of every column that has a value: exact, all columns in one shuffle.

    (position, value) pairs collapse inside the tasks first, so a hot value travels once a task; the second count
    adds one number a task and column.
    """
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), _identity(f.name, f.dataType).alias("value")) for i, f in enumerate(df.schema.fields)])))
    return pairs.filter("value IS NOT NULL").distinct().groupBy("position").agg(F.count(F.lit(1)).alias("n_distinct"))


def dataset_profile(df: DataFrame, target: str, exact: bool = True) -> DataFrame:
    """One row per column: row and feature counts, nulls, NaNs, distinct values (nulls aside), min, max.

    ``exact=False`` leaves out the shuffle of ``distinct_counts`` and estimates (HyperLogLog++) in the one pass of the rest.
    """
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        floating = isinstance(f.dataType, (T.DoubleType, T.FloatType))
        numeric = isinstance(f.dataType, T.NumericType)
        aggs += [
            F.count_if(c.isNull()).alias(f"nulls{i}"),
            (F.count_if(F.isnan(c)) if floating else F.lit(0).cast("bigint")).alias(f"nans{i}"),
            (F.lit(0).cast("bigint") if exact else F.approx_count_distinct(c)).alias(f"distinct{i}"),
            (F.min(c).cast("double") if numeric else F.lit(None).cast("double")).alias(f"min{i}"),
            (F.max(c).cast("double") if numeric else F.lit(None).cast("double")).alias(f"max{i}"),
        ]
    one = df.agg(*aggs)
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(kind_of(f.dataType)).alias("kind"),
                 F.col(f"nulls{i}").alias("n_null"), F.col(f"nans{i}").alias("n_nan"),
                 F.col(f"distinct{i}").alias("n_distinct"), F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"))
        for i, f in enumerate(fields)
    ]
    table = one.select(
        F.col("n").alias("n_rows"), F.lit(len(fields) - 1).alias("n_features"), F.lit(target).alias("target"),
        F.inline(F.array(*entries)),
    )
    if exact:
        table = table.drop("n_distinct").join(distinct_counts(df), "position", "left")
    return table.select("n_rows", "n_features", "target", "column", "kind", "n_null", "n_nan",
                        F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), "min", "max")
