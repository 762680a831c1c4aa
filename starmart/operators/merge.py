"""Upsert with the rules of MERGE, for tables whose catalog has none."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.keys import made_again, unless_made
from starmart.operators.lookup import BROADCAST_BYTES, broadcast_size


def reject_ambiguous(target: DataFrame, source: DataFrame, on: str) -> None:
    """Fails if several source rows match one target row, whatever is read of the merge later.

    Keys that the source may repeat are found first, by a hash of 8 bytes; where there are none, nothing else is read.
    """
    hashed = source.filter(F.col(on).isNotNull()).groupBy(F.xxhash64(on)).count()
    if hashed.filter("count > 1").isEmpty():
        return
    repeated = source.groupBy(on).count().filter("count > 1").select(on)
    match = target.select(on).join(repeated, on, "left_semi").first()
    if match:
        raise ValueError(f"several source rows match {on} {match[0]}")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    on: str,
    update_when: Column,
    update_columns: Sequence[str],
    frozen: DataFrame | None = None,
    made_of: tuple[Callable[..., Column], Sequence[str]] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The target after the merge.

    A matched target row takes ``update_columns`` from the source where ``update_when`` (over target columns) holds; a
    target row with several source rows fails the call; source rows without a match are added. ``source`` is read several
    times, so pass a stored one. While it is small, Spark broadcasts it and never shuffles the target.

    ``frozen`` has the target rows that ``update_when`` never holds for, if they are kept elsewhere: only their keys are read,
    and they are not in the result.

    ``made_of`` has a function and the columns of both that usually give ``on``. If the source is too large to broadcast,
    target and source then meet in one join by a hash of 8 bytes, and only keys that are made otherwise move themselves.
    """
    keys = target.select(on) if frozen is None else target.select(on).unionByName(frozen.select(on))
    reject_ambiguous(keys, source, on)
    if made_of is not None and broadcast_size(source.select(on, *update_columns)) > broadcast_bytes:
        return _merged_by_hash(target, source, on, update_when, update_columns, frozen, *made_of)
    changes = source.select(
        F.col(on).alias("_on"), *[F.col(c).alias(f"_new_{c}") for c in update_columns], F.lit(True).alias("_matched")
    )

    def merged(column: str) -> Column:
        if column not in update_columns:
            return F.col(column)
        return (
            F.when(F.col("_matched") & update_when, F.col(f"_new_{column}")).otherwise(F.col(column)).alias(column)
        )

    updated = target.join(changes, F.col(on) == F.col("_on"), "left").select(*[merged(c) for c in target.columns])
    known = keys.join(source.select(on), on, "left_semi")
    added = source.join(known, on, "left_anti").select(*target.columns)
    return updated.unionByName(added)


def _merged_by_hash(
    target: DataFrame,
    source: DataFrame,
    on: str,
    update_when: Column,
    update_columns: Sequence[str],
    frozen: DataFrame | None,
    make: Callable[..., Column],
    parts: Sequence[str],
) -> DataFrame:
    """The merge as one full outer join; frozen keys stand among the target rows and are left out again."""

    def moved(df: DataFrame) -> DataFrame:
        number = F.when(F.col(on).isNotNull(), F.xxhash64(on))
        other = unless_made(on, make(*map(F.col, parts)))
        return df.withColumns({"_hash": number, "_other": other}).drop(on)

    def key(side: str) -> Column:
        return made_again(F.col(f"{side}._other"), make(*[F.col(f"{side}.{c}") for c in parts]))

    rows = moved(target.withColumns({"_update": update_when, "_frozen": F.lit(False)}))
    if frozen is not None:
        theirs = moved(frozen.select(on, *[c for c in parts if c != on])).withColumn("_frozen", F.lit(True))
        rows = rows.unionByName(theirs, allowMissingColumns=True)
    # Equal hashes meet; whether the keys are equal is asked of those pairs only, so that no key is shuffled or sorted.
    equal = F.coalesce(key("t") == key("s"), F.lit(False))
    met = rows.alias("t").join(moved(source).alias("s"), (F.col("t._hash") == F.col("s._hash")) & equal, "fullouter")
    met = met.filter(~F.coalesce("t._frozen", F.lit(False)))
    missing = F.col("t._frozen").isNull()
    updated = missing | (F.col("s._hash").isNotNull() & F.col("_update"))

    def merged(column: str) -> Column:
        if column == on:
            return F.when(missing, key("s")).otherwise(key("t")).alias(on)
        taken = updated if column in update_columns else missing
        return F.when(taken, F.col(f"s.{column}")).otherwise(F.col(f"t.{column}")).alias(column)

    return met.select(*[merged(c) for c in target.columns])
