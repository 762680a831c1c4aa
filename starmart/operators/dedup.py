"""Deterministic deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the lowest by ``order_by``, then by every other column, NULLs lowest.

    The order is total, so reruns and lost executors give the same row. Spark keeps one row per key in each task before
    the shuffle (window group limit), so a key that holds a third of the input sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    order = [F.asc_nulls_first(c) for c in (*order_by, *rest)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
