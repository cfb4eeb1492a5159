"""Side-by-side submission of Spark jobs from driver threads, with limits."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def _wrapped(spark: SparkSession | None, fn: Callable) -> Callable:
    return inheritable_thread_target(spark)(fn) if spark is not None else inheritable_thread_target(fn)


def run_all(tasks: Sequence[Callable], parallelism: int = 4) -> list:
    """Run the callables and return their results in order; the first error is raised."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    spark = SparkSession.getActiveSession()
    with ThreadPoolExecutor(max_workers=min(parallelism, len(tasks))) as pool:
        return [f.result() for f in [pool.submit(_wrapped(spark, t)) for t in tasks]]


@dataclass
class Outcome:
    """``status`` is ok, failed, timeout or skipped."""

    status: str
    value: Any = None
    error: str = ""
    seconds: float = 0.0


def run_limited(spark: SparkSession, tasks: Sequence[Callable], parallelism: int = 1,
                task_seconds: float | None = None, total_seconds: float | None = None) -> list[Outcome]:
    """Run every task; errors and overruns become outcomes instead of ending the batch.

    An overrunning task's Spark jobs are cancelled by job tag. After
    ``total_seconds`` nothing new starts and running tasks are cancelled.
    """
    sc = spark.sparkContext
    tags = [f"fitmesh-{uuid.uuid4().hex}" for _ in tasks]
    began: dict[int, float] = {}
    cancelled: set[int] = set()
    deadline = time.monotonic() + total_seconds if total_seconds is not None else None

    def job(i: int) -> Outcome:
        if deadline is not None and time.monotonic() >= deadline:
            return Outcome("skipped", error="time budget used up")
        began[i] = time.monotonic()
        sc.addJobTag(tags[i])
        try:
            value = tasks[i]()
            late = i in cancelled
            return Outcome("timeout" if late else "ok", None if late else value, "time limit" if late else "",
                           time.monotonic() - began[i])
        except Exception as e:  # a failing task must not end the batch
            status = "timeout" if i in cancelled else "failed"
            return Outcome(status, error=f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:500],
                           seconds=time.monotonic() - began[i])
        finally:
            sc.removeJobTag(tags[i])

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(tasks) or 1))) as pool:
        futures = [pool.submit(_wrapped(spark, lambda i=i: job(i))) for i in range(len(tasks))]
        while any(not f.done() for f in futures):
            now = time.monotonic()
            for i, f in enumerate(futures):
                if f.done() or i not in began:
                    continue
                over = task_seconds is not None and now - began[i] > task_seconds
                if over or (deadline is not None and now > deadline):
                    cancelled.add(i)
                    sc.cancelJobsWithTag(tags[i])  # repeated: a driver loop may submit another job
            time.sleep(0.05)
        return [f.result() for f in futures]
