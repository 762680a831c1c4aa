"""The jobs of a mart and one daily run of all of them."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.config import MartConfig
from starmart.operators.scd2 import (
    DimensionSpec,
    high_watermark,
    open_after_changes,
    scd2_changes,
    stage_dimension,
    unknown_version,
)
from starmart.plans.dimensions import SPECS, calendar_dimension
from starmart.plans.facts import fact_order_items, fact_order_summary
from starmart.plans.staging import stage_order_items, stage_orders
from starmart.plans.together import together
from starmart.sources.contracts import TABLES, broken_columns, conform, enforce_contract, relaxed
from starmart.sources.files import read_parquet, write_parquet
from starmart.sources.runs import kept_watermark, shuffles_deleted, unsorted_writes, write_day, write_versions
from starmart.sources.tables import (
    ensure_tables,
    load_table,
    merge_into_table,
    read_table,
    switch_snapshot,
)

logger = logging.getLogger(__name__)

# Names of the source files.
RAW_FILES = ("customers", "sellers", "products", "orders", "order_items")

Raw = Mapping[str, DataFrame]


def raw_sources(spark: SparkSession, cfg: MartConfig) -> dict[str, DataFrame]:
    return {name: read_parquet(spark, cfg.inputs, name) for name in RAW_FILES}


def _checked(df: DataFrame, cfg: MartConfig, name: str) -> DataFrame:
    """The rows as the table takes them; types are narrowed here and nowhere before."""
    if cfg.strict:
        return enforce_contract(df, TABLES[name])
    return conform(df, relaxed(TABLES[name]))


def _staged(cfg: MartConfig, df: DataFrame, name: str) -> DataFrame:
    write_parquet(df, cfg.staging, name)
    return read_parquet(df.sparkSession, cfg.staging, name)


def migrate(spark: SparkSession, cfg: MartConfig) -> None:
    """Create what is missing and rebuild the date dimension."""
    ensure_tables(spark, cfg)
    dates = calendar_dimension(spark, cfg.calendar)
    if cfg.row_level:
        load_table(dates, cfg.table("dim_date"), "overwrite", cfg.table_format)
    else:
        switch_snapshot(dates, cfg.table("dim_date"), cfg.folder("dim_date"))


def refresh_orders(cfg: MartConfig, raw: Raw) -> None:
    _staged(cfg, stage_orders(raw["orders"]), "stg_orders")


def refresh_order_items(cfg: MartConfig, raw: Raw) -> None:
    _staged(cfg, stage_order_items(raw["order_items"], raw["orders"]), "stg_order_items")


def refresh_dimension(cfg: MartConfig, raw: Raw, spec: DimensionSpec, as_of: dt.date) -> None:
    """Stage the source, find the changes and merge them into the dimension.

    A file table gets its open versions written anew and the newly closed ones added; earlier closed ones stay where they
    are.
    """
    source, table = raw[spec.source], cfg.table(spec.table)
    spark = source.sparkSession
    ensure_tables(spark, cfg, [spec.table])
    current = read_table(spark, table)
    if cfg.row_level:
        watermark = high_watermark(current, cfg.floor_date).scalar()
    else:
        watermark = F.lit(kept_watermark(spark, cfg.folder(spec.table)) or cfg.floor_date)
    staged = stage_dimension(spec, source, watermark)
    changes = scd2_changes(spec, staged, current, as_of)
    if cfg.unknown_members:
        unknown = unknown_version(spec, spark, cfg.floor_date)
        changes = changes.unionByName(unknown.join(current.select(spec.sk), spec.sk, "left_anti"))
    changes = _staged(cfg, changes, f"changes_{spec.table}")
    if cfg.row_level:
        merge_into_table(changes, table, spec.sk, F.col(f"{table}.is_current"), ["effective_to", "is_current"])
    else:
        merged = open_after_changes(spec, current, changes)
        write_versions(_checked(merged, cfg, spec.table), table, cfg.folder(spec.table))


def _load_fact(fact: DataFrame, cfg: MartConfig, name: str, as_of: dt.date) -> None:
    """Puts a run's rows in place of those of an earlier run for the same date; catalogs of other formats append."""
    table, schema = cfg.table(name), TABLES[name]
    if cfg.row_level:
        load_table(_checked(fact, cfg, name), table, "append", cfg.table_format)
    elif cfg.quarantine:
        rows = conform(fact, relaxed(schema))
        counts = write_day(rows, table, cfg.folder(name), as_of, schema, broken_columns(schema))
        if counts:
            logger.warning("%s of %s set rows aside, by column that breaks the contract: %s", name, as_of, counts)
    else:
        rows = _checked(fact, cfg, name)
        write_day(rows, table, cfg.folder(name), as_of, schema if cfg.strict else relaxed(schema))


def load_order_items(spark: SparkSession, cfg: MartConfig, as_of: dt.date) -> None:
    ensure_tables(spark, cfg, ["dim_seller", "dim_product", "fact_order_items"])
    fact = fact_order_items(
        read_parquet(spark, cfg.staging, "stg_order_items"),
        read_table(spark, cfg.table("dim_seller")),
        read_table(spark, cfg.table("dim_product")),
        cfg.calendar,
        unknown=cfg.unknown_members,
        contiguous=cfg.contiguous_validity,
    )
    _load_fact(fact, cfg, "fact_order_items", as_of)


def load_order_summary(spark: SparkSession, cfg: MartConfig, as_of: dt.date) -> None:
    ensure_tables(spark, cfg, ["dim_customer", "fact_order_summary"])
    fact = fact_order_summary(
        read_parquet(spark, cfg.staging, "stg_orders"),
        read_parquet(spark, cfg.staging, "stg_order_items"),
        read_table(spark, cfg.table("dim_customer")),
        cfg.calendar,
        unknown=cfg.unknown_members,
        contiguous=cfg.contiguous_validity,
    )
    _load_fact(fact, cfg, "fact_order_summary", as_of)


def run_daily(spark: SparkSession, cfg: MartConfig, as_of: dt.date, raw: Raw | None = None) -> None:
    """Migrations, then staging and dimensions, then facts.

    A run may be repeated, whether the first one ended or failed: dimensions find nothing new, and facts of the same
    processing date are replaced.
    """
    raw = raw or raw_sources(spark, cfg)
    migrate(spark, cfg)
    with unsorted_writes(spark), shuffles_deleted(spark):
        together(
            partial(refresh_orders, cfg, raw),
            partial(refresh_order_items, cfg, raw),
            *[partial(refresh_dimension, cfg, raw, spec, as_of) for spec in SPECS.values()],
        )
        logger.info("staged orders and order items, refreshed dimensions as of %s", as_of)
        together(partial(load_order_items, spark, cfg, as_of), partial(load_order_summary, spark, cfg, as_of))
    logger.info("loaded facts")
