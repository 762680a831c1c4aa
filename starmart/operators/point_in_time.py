"""As-of join of events with the versions of a type 2 dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.keys import surrogate_key
from starmart.operators.lookup import BROADCAST_BYTES, KeySketches, broadcast_size, hot_keys_unless_small, lookup_join

# The last day that Spark has: where a current version ends.
LAST_DAY = (1 << 31) - 1


def valid_versions(dimension: DataFrame, key: str, sk: str, contiguous: bool = False) -> DataFrame:
    """What a join needs of a dimension's versions: key, first day, day after the last.

    Surrogate keys that follow from key and first day are left out, and made again by ``with_surrogate_key``: shuffles and
    sorts of a join would mostly move these 64 characters. Any others are carried, as an array of one.
    """
    ends, current = F.col("effective_to"), F.col("is_current")
    if contiguous:
        ends = F.lead("effective_from").over(Window.partitionBy(key).orderBy("effective_from", "is_current", sk))
        current = ends.isNull()
    follows = F.col(sk).eqNullSafe(surrogate_key(F.col(key), F.col("effective_from")))
    return dimension.select(
        key,
        F.col("effective_from").alias(f"_from_{sk}"),
        F.when(current, F.date_from_unix_date(F.lit(LAST_DAY))).otherwise(ends).alias(f"_to_{sk}"),
        F.when(~follows, F.array(sk)).alias(f"_other_{sk}"),
    )


def versions_size(versions: DataFrame, sk: str) -> int:
    return broadcast_size(versions.withColumn(f"_other_{sk}", F.get(f"_other_{sk}", F.lit(0))))


def join_versions(
    events: DataFrame,
    versions: DataFrame,
    key: str,
    event_date: str,
    sk: str,
    hot: dict[object, int] | None,
    *,
    spread: Sequence[str],
) -> DataFrame:
    """Events with each of ``valid_versions`` on their date, if any; ``with_surrogate_key`` completes them."""
    day = F.col(event_date)
    valid = (day >= F.col(f"_from_{sk}")) & (day < F.col(f"_to_{sk}"))
    return lookup_join(events, versions, key, "left", hot, spread=spread, residual=valid).drop(f"_to_{sk}")


def with_surrogate_key(joined: DataFrame, key: str, sk: str, unknown: str | None = None) -> DataFrame:
    """Adds the surrogate key of the joined version, ``unknown`` where there is none."""
    first, other = F.col(f"_from_{sk}"), F.col(f"_other_{sk}")
    value = F.when(other.isNotNull(), F.get(other, F.lit(0))).when(first.isNotNull(), surrogate_key(F.col(key), first))
    if unknown is not None:
        value = F.coalesce(value, F.lit(unknown))
    return joined.withColumn(sk, value).drop(f"_from_{sk}", f"_other_{sk}")


def point_in_time_join(
    events: DataFrame,
    dimension: DataFrame,
    key: str,
    event_date: str,
    sk: str,
    *,
    spread: Sequence[str],
    hot_in: DataFrame | KeySketches | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    unknown: str | None = None,
    contiguous: bool = False,
    hot: dict[object, int] | None = None,
) -> DataFrame:
    """Events with the surrogate key of every version valid on the event date, ``unknown`` where none is.

    A version is valid from ``effective_from`` until before ``effective_to``, a current one without end. Versions that
    overlap each give a row. ``dimension`` must be a stored table: its size is counted to choose the join. ``hot_in``
    may name a cheaper place than ``events`` to look for hot keys, or sketches that several joins share. ``contiguous``
    validity ends where the key's next version begins, so versions neither overlap nor leave a gap. ``hot`` keys that are
    known make the choice: neither size nor keys are looked for.
    """
    versions = valid_versions(dimension, key, sk, contiguous)
    if hot is None:
        size = versions_size(versions, sk)
        hot = hot_keys_unless_small(events if hot_in is None else hot_in, key, size, broadcast_bytes)
    joined = join_versions(events, versions, key, event_date, sk, hot, spread=spread)
    return with_surrogate_key(joined, key, sk, unknown)
