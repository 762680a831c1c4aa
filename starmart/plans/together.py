"""Independent steps of a plan side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


def together(*steps: Callable[[], T]) -> list[T]:
    """Results of steps that do not depend on each other, submitted to Spark at the same time.

    They keep the caller's job group, tags and scheduler pool.
    """
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(steps)) as pool:
        return [done.result() for done in [pool.submit(inherit(step)) for step in steps]]
