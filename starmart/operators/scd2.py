"""Type 2 slowly changing dimensions: staging, change detection and load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, FloatType, StringType, StructType

from starmart.functions.keys import (
    any_differs,
    effective_update_date,
    made_again,
    surrogate_key,
    unless_made,
    updated_after,
)
from starmart.operators.dedup import keep_first
from starmart.operators.merge import merge_upsert
from starmart.sources.contracts import conform

# Fixed value: the surrogate key, and every text, of the unknown member of a type 2 dimension.
UNKNOWN_SK = "unknown"


@dataclass(frozen=True)
class DimensionSpec:
    """What distinguishes one dimension from another."""

    table: str
    source: str
    schema: StructType
    key: str
    sk: str
    attributes: tuple[str, ...]
    # Attributes whose change opens a new version; the others are refreshed along with it.
    tracked: tuple[str, ...]
    updated: str
    created: str
    renames: dict[str, str] = field(default_factory=dict)


def high_watermark(dimension: DataFrame, floor: dt.date, column: str = "effective_to") -> DataFrame:
    """One row: the latest ``column`` value, or the floor date of a table that has none."""
    return dimension.agg(F.coalesce(F.max(column), F.to_date(F.lit(floor.isoformat()))).alias("max_date"))


def stage_dimension(spec: DimensionSpec, raw: DataFrame, watermark: Column) -> DataFrame:
    """Raw rows updated after the watermark, the earliest one per key."""
    fresh = (
        raw.filter(updated_after(raw.schema, spec.updated, spec.created, watermark))
        .withColumn(spec.updated, effective_update_date(raw.schema, spec.updated, spec.created))
        .withColumnsRenamed({**spec.renames, spec.created: "created_date", spec.updated: "updated_date"})
        .select(spec.key, *spec.attributes, "created_date", "updated_date")
    )
    return keep_first(fresh, [spec.key], ["updated_date", *spec.tracked])


def _diff(spec: DimensionSpec, staged: DataFrame, dimension: DataFrame) -> DataFrame:
    """Staged rows next to the current version of their key, where there is none or a tracked attribute differs.

    A left join: dimension rows without a staged row never produce a change, so a full outer join adds nothing. Surrogate
    keys that follow from key and first day stay behind, see ``_closed_version``.
    """
    made = surrogate_key(F.col(spec.key), F.col("effective_from"))
    current = dimension.filter(F.col("is_current")).withColumn("_other", unless_made(spec.sk, made)).drop(spec.sk)
    s, d = staged.alias("s"), current.alias("d")
    changed = any_differs([(F.col(f"d.{c}"), F.col(f"s.{c}")) for c in spec.tracked])
    return s.join(d, F.col(f"s.{spec.key}") == F.col(f"d.{spec.key}"), "left").filter(_unknown(spec) | changed)


def _unknown(spec: DimensionSpec) -> Column:
    return F.col(f"d.{spec.key}").isNull()


def _new_version(spec: DimensionSpec) -> dict[str, Column]:
    return {
        spec.sk: surrogate_key(F.col(f"s.{spec.key}"), F.col("s.updated_date")),
        **{c: F.col(f"s.{c}") for c in (spec.key, *spec.attributes)},
        "effective_from": F.col("s.updated_date"),
        "effective_to": F.lit(None).cast("date"),
    }


def _closed_version(spec: DimensionSpec, as_of: dt.date) -> dict[str, Column]:
    sk = made_again(F.col("d._other"), surrogate_key(F.col(f"d.{spec.key}"), F.col("d.effective_from")))
    return {
        spec.sk: sk,
        **{c: F.col(f"d.{c}") for c in (spec.key, *spec.attributes, "effective_from")},
        "effective_to": F.date_sub(F.lit(as_of), 1),
    }


def scd2_new(spec: DimensionSpec, staged: DataFrame, dimension: DataFrame) -> DataFrame:
    """Versions to open: unknown keys and keys with a changed tracked attribute."""
    rows = _diff(spec, staged, dimension).select(*[c.alias(n) for n, c in _new_version(spec).items()])
    return conform(rows.withColumn("is_current", F.lit(True)), spec.schema)


def scd2_expired(spec: DimensionSpec, staged: DataFrame, dimension: DataFrame, as_of: dt.date) -> DataFrame:
    """Current versions to close, on the day before ``as_of``."""
    rows = (
        _diff(spec, staged, dimension)
        .filter(~_unknown(spec))
        .select(*[c.alias(n) for n, c in _closed_version(spec, as_of).items()])
    )
    return conform(rows.withColumn("is_current", F.lit(False)), spec.schema)


def scd2_changes(spec: DimensionSpec, staged: DataFrame, dimension: DataFrame, as_of: dt.date) -> DataFrame:
    """``scd2_new`` and ``scd2_expired`` in one pass: a changed key becomes two rows after a single join."""
    flags = F.when(_unknown(spec), F.array(F.lit(True))).otherwise(F.array(F.lit(True), F.lit(False)))
    opened, closed = _new_version(spec), _closed_version(spec, as_of)
    rows = (
        _diff(spec, staged, dimension)
        .withColumn("_open", F.explode(flags))
        .select(
            *[F.when(F.col("_open"), opened[c]).otherwise(closed[c]).alias(c) for c in opened],
            F.col("_open").alias("is_current"),
        )
    )
    return conform(rows, spec.schema)


def _merge(spec: DimensionSpec, target: DataFrame, changes: DataFrame, frozen: DataFrame | None = None) -> DataFrame:
    made_of = surrogate_key, (spec.key, "effective_from")
    when, columns = F.col("is_current"), ["effective_to", "is_current"]
    return merge_upsert(target, changes, spec.sk, when, columns, frozen, made_of)


def apply_changes(spec: DimensionSpec, dimension: DataFrame, changes: DataFrame) -> DataFrame:
    return _merge(spec, dimension, changes)


def open_after_changes(spec: DimensionSpec, dimension: DataFrame, changes: DataFrame) -> DataFrame:
    """What a run writes: the versions open before or after it. Those closed earlier are only looked up by key."""
    return _merge(spec, dimension.filter("is_current"), changes, dimension.filter("NOT is_current"))


def unknown_version(spec: DimensionSpec, spark: SparkSession, since: dt.date) -> DataFrame:
    """The reserved version that facts without a valid one refer to."""
    blank = {StringType: UNKNOWN_SK, DecimalType: Decimal(0), FloatType: 0.0, DateType: since, BooleanType: True}
    row = [None if f.nullable else blank[type(f.dataType)] for f in spec.schema.fields]
    return spark.createDataFrame([tuple(row)], spec.schema)


def load_dimension(
    spec: DimensionSpec,
    raw: DataFrame,
    dimension: DataFrame,
    as_of: dt.date,
    floor: dt.date,
    store: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    """The dimension after one batch of raw rows.

    ``store`` writes the changes once; they are few next to the raw rows, and the merge reads them three times.
    """
    staged = stage_dimension(spec, raw, high_watermark(dimension, floor).scalar())
    changes = store(scd2_changes(spec, staged, dimension, as_of), f"changes_{spec.table}")
    return apply_changes(spec, dimension, changes)
