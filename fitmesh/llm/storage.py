"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from fitmesh.session import durable
from fitmesh.sources.records import scratch_path

_ONCE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",  # else shuffle files stay until the driver's garbage is collected
         "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}  # texts: tens of MB in a batch of 10,000


@contextmanager
def once(spark: SparkSession) -> Iterator[None]:
    """For results that are computed once and read back: their shuffle files go when the query ends, batches of texts are small."""
    before = {k: spark.conf.get(k, None) for k in _ONCE}
    try:
        for k, v in _ONCE.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: later steps survive lost executors."""
    path = scratch_path(df.sparkSession, name)
    with once(df.sparkSession):
        df.select("*").write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """``durable``, without the shuffle files that made ``df``."""
    with once(df.sparkSession):
        return durable(df.select("*"))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df
