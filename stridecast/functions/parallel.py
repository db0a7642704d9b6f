"""Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import partial
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")
R = TypeVar("R")


def run_all(
    spark: SparkSession, fn: Callable[[T], R], arguments: Iterable[T], parallelism: int
) -> list[R]:
    """``fn`` of every argument, up to ``parallelism`` at a time, in order."""
    as_thread = inheritable_thread_target(spark)
    tasks = [as_thread(partial(fn, a)) for a in arguments]
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return pool.map(lambda task: task(), tasks, chunksize=1)
