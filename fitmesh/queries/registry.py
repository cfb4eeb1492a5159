"""Registration and the shared views of the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitmesh.functions.hashing import key_text
from fitmesh.functions.vectors import assemble
from fitmesh.session import spread
from fitmesh.sources.tables import load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "_q"]


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """``id, qty, price, disc, tax, label`` (revenue) of every lineitem row; ``extra`` keeps further columns."""
    used = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
            "l_linestatus"]
    li = spread(table(spark, sf_dir, "lineitem").select(*used)).withColumn("_q", F.col("l_quantity").cast("int"))
    return li.select(
        key_text(LINE_KEY).alias("id"), F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"),
        F.expr("l_extendedprice * (1 - l_discount) * (1 + l_tax)").alias("label"), *extra)


def with_features(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    return assemble(df, columns).select(*keep, "label", "features")


LI = """li AS (SELECT concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER)) AS id,
  l_quantity AS qty, l_extendedprice AS price, l_discount AS disc, l_tax AS tax,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS label, l_returnflag, l_linestatus, l_suppkey FROM lineitem)"""


def hash_sql(*salt: int, key: str = "id") -> str:
    parts = ", ".join([*[f"'{s}'" for s in salt], key])
    return f"(('0x' || substr(md5(concat_ws(':', {parts})), 1, 15))::BIGINT)"


def metrics_sql(y: str, p: str) -> str:
    """R2, RMSE, MAE select list."""
    return (f"1 - sum(pow({y} - {p}, 2)) / (count(*) * var_pop({y})) AS r2, sqrt(avg(pow({y} - {p}, 2))) AS rmse, "
            f"avg(abs({y} - {p})) AS mae")


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), d) for c, d in digits.items()})
