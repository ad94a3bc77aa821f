"""Submitting independent Spark actions side by side from one driver."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def run_all(spark: SparkSession, actions: Iterable[Callable[[], T]], limit: int = 5) -> list[T]:
    """Run the actions in up to ``limit`` threads and return their results in order; the first failure raises.

    Jobs of one action fill the cores that another's last tasks leave idle.
    """
    pending = list(actions)
    if not pending:
        return []

    @inheritable_thread_target(spark)
    def call(action: Callable[[], T]) -> T:
        return action()

    with ThreadPool(max(1, min(limit, len(pending)))) as pool:
        return pool.map(call, pending, chunksize=1)
