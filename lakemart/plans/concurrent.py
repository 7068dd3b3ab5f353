"""Submitting independent Spark jobs side by side.

One small table leaves most of a cluster idle and so does the tail of a large one;
jobs that do not depend on each other are therefore submitted from several threads.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

A = TypeVar("A")
B = TypeVar("B")
MAX_JOBS = 8


def each(spark: SparkSession, job: Callable[[A], B], items: Iterable[A]) -> list[B]:
    """``job`` for every item, in parallel. The first error is raised after all ended."""
    items = list(items)
    if not items:
        return []
    # A target for each: threads of one target share its local properties, and with them the number of the query.
    targets = [inheritable_thread_target(spark)(job) for _ in items]
    with ThreadPoolExecutor(min(MAX_JOBS, len(items))) as pool:
        return [f.result() for f in [pool.submit(t, item) for t, item in zip(targets, items)]]
