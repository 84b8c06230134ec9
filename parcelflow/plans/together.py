"""Running jobs: independent ones at the same time, so that small ones fill the gaps of large ones, and without leaving files behind."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def together(spark: SparkSession, jobs: dict[str, Callable[[], T]], width: int = 8) -> dict[str, T]:
    """Results by name; waits for all, then raises the first failure in order, if any."""
    with ThreadPoolExecutor(width) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
    return {name: future.result() for name, future in running.items()}


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a query go when the query ends.

    Otherwise they stay until the driver happens to collect its garbage, so that those of all steps add up on the
    executors' disks. A DataFrame that is executed twice computes its shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
