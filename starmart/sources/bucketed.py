"""Tables stored for joins by one key.

Rows are bucketed and sorted by the key, so a join of two such tables with the same number of buckets shuffles neither. Rows
of hot keys, and rows without a key, would fill single buckets: they are kept apart, spread as they came, and join the
few versions of their keys by broadcast or by pieces.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.lookup import KeySketches
from starmart.operators.point_in_time import point_in_time_join
from starmart.sources.runs import quoted


@dataclass(frozen=True)
class Bucketed:
    """A table of bucketed rows, where the rows of ``hot`` keys and those without a key lie, and how it is dealt."""

    table: str
    apart: str
    key: str
    buckets: int
    hot: tuple[object, ...]

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.table(self.table)

    def rows_apart(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.rows(spark).schema).parquet(self.apart)


def write_bucketed(
    df: DataFrame, table: str, location: str, key: str, buckets: int, hot_in: KeySketches | None = None
) -> Bucketed:
    """Stores ``df``, which is read twice; without ``hot_in`` no key is taken for hot, as in a dimension."""
    hot = {} if hot_in is None else hot_in.hot(key)
    keys = tuple(item for item in hot if item is not None)
    apart = F.col(key).isNull() | F.col(key).isin(*keys) if keys else F.col(key).isNull()
    place = f"{location.rstrip('/')}/apart"
    df.filter(apart).write.parquet(place)
    cold = df.filter(~apart).repartition(buckets, key)
    options = cold.write.option("path", f"{location.rstrip('/')}/buckets").format("parquet")
    options.bucketBy(buckets, key).sortBy(key).saveAsTable(quoted(table))
    return Bucketed(table, place, key, buckets, keys)


def bucketed_point_in_time_join(
    spark: SparkSession, events: Bucketed, versions: Bucketed, event_date: str, sk: str, *, spread: Sequence[str]
) -> DataFrame:
    """``point_in_time_join`` of stored tables with the same key and number of buckets; only rows kept apart move."""
    if (events.key, events.buckets) != (versions.key, versions.buckets):
        raise ValueError(f"{events.table} and {versions.table} are dealt differently")
    dimension, key = versions.rows(spark), events.key
    # No bucket of events has a hot key, so nothing is to be cut into pieces.
    met = point_in_time_join(events.rows(spark), dimension, key, event_date, sk, spread=spread, hot={})
    theirs = dimension.filter(F.col(key).isin(*events.hot)) if events.hot else dimension.filter(F.lit(False))
    rest = point_in_time_join(events.rows_apart(spark), theirs, key, event_date, sk, spread=spread)
    return met.unionByName(rest)
