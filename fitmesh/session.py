"""Session construction and durable materialisation."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "fitmesh", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the library expects (UTC, AQE, Arrow, FAIR scheduling).

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submit
    command and AQE decide both.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", os.environ.get("FITMESH_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; make a private one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fitmesh-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return sc.getCheckpointDir()


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a table with fewer input splits than half the cores; others are left as they are.

    Meant for table scans: counting their splits runs no job.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def held(df: DataFrame) -> DataFrame:
    """Persist a table that is read many times, spread over all cores.

    Only inputs with fewer partitions than cores are redistributed; a large
    table keeps its partitions and is not shuffled. Unpersist when done.
    """
    data = df.persist(StorageLevel.MEMORY_AND_DISK)
    cores = df.sparkSession.sparkContext.defaultParallelism
    if data.rdd.getNumPartitions() >= cores:
        return data
    data.unpersist()  # nothing was computed yet
    return df.repartition(cores).persist(StorageLevel.MEMORY_AND_DISK)


@contextmanager
def holding(df: DataFrame) -> Iterator[DataFrame]:
    """``held`` inside the block. A table that its caller holds is used as it is and stays held: Spark has one cache entry for both."""
    if df.storageLevel != StorageLevel.NONE:
        yield df
        return
    data = held(df)
    try:
        yield data
    finally:
        data.unpersist()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and cut its lineage; survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # else shuffle files stay until the driver's garbage is collected
_cleaning, _lock = [], Lock()  # the setting before, once for every block under way


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Inside the block the shuffle files of a query go when it ends. For work in rounds, so that disk does not grow with their number."""
    with _lock:
        _cleaning.append(_cleaning[0] if _cleaning else spark.conf.get(_CLEANED, None))
        spark.conf.set(_CLEANED, "true")
    try:
        yield
    finally:
        with _lock:
            before = _cleaning.pop()
            if not _cleaning:
                spark.conf.unset(_CLEANED) if before is None else spark.conf.set(_CLEANED, before)


def released(df: DataFrame) -> None:
    """Deletes the checkpoint of a ``durable`` table that nothing reads any more."""
    spark, file = df.sparkSession, df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        path = spark._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
