"""Catalog tables: namespace, DDL, append, overwrite, snapshot switch and row-level merge."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart.config import MartConfig
from starmart.sources.contracts import FACTS, HISTORIES, TABLES, relaxed
from starmart.sources.runs import KEPT_COPIES, attach_days, attach_versions, folder, quoted

# Snapshots of a file table are numbered folders; Spark's marker, written last, tells the finished ones.
SNAPSHOT = re.compile(r"snapshot-(\d+)")
FINISHED = "_SUCCESS"


def _snapshots(spark: SparkSession, base: str) -> list[tuple[int, str, bool]]:
    """Number, location and completeness of every snapshot below ``base``, oldest first."""
    files, place = folder(spark, base)
    if not files.exists(place):
        return []
    found = [status.getPath() for status in files.listStatus(place)]
    numbered = [(SNAPSHOT.fullmatch(p.getName()), p.toString()) for p in found]
    done = [(m, p, folder(spark, f"{p}/{FINISHED}")[1]) for m, p in numbered if m]
    return sorted((int(m[1]), p, files.exists(marker)) for m, p, marker in done)


def live_snapshot(spark: SparkSession, base: str) -> str | None:
    """Location of the newest finished snapshot, whatever the session's catalog knows."""
    finished = [location for _, location, done in _snapshots(spark, base) if done]
    return finished[-1] if finished else None


def _located(location: str | None) -> str:
    escaped = location and location.replace("\\", "\\\\").replace("'", "\\'")
    return f" LOCATION '{escaped}'" if location else ""


def create_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted(namespace)}{_located(location)}")


def create_table(
    spark: SparkSession, table: str, schema: StructType, table_format: str = "parquet", location: str | None = None
) -> None:
    columns = ", ".join(
        f"{quoted(f.name)} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({columns}) USING {table_format}{_located(location)}")


def ensure_tables(spark: SparkSession, cfg: MartConfig, names: Iterable[str] = tuple(TABLES)) -> None:
    """Namespace and mart tables of these names, empty where no data exist yet.

    File tables are attached to what is live in their folders, so that a session with a new catalog goes on where the last
    ended. No other step may replace them meanwhile.
    """
    create_namespace(spark, cfg.namespace, None if cfg.row_level else cfg.warehouse.rstrip("/"))
    for name in names:
        table, schema = cfg.table(name), TABLES[name] if cfg.strict else relaxed(TABLES[name])
        if cfg.row_level:
            create_table(spark, table, schema, cfg.table_format)
        elif not _attach_live(spark, cfg, name, schema):
            create_table(spark, table, schema, cfg.table_format, f"{cfg.folder(name)}/initial")


def _attach_live(spark: SparkSession, cfg: MartConfig, name: str, schema: StructType) -> bool:
    """Whether the folder of a file table has finished rows, which the catalog then shows."""
    table, base = cfg.table(name), cfg.folder(name)
    if name in HISTORIES:
        return attach_versions(spark, table, base, schema)
    if name in FACTS:
        return attach_days(spark, table, base, schema, cfg.quarantine)
    live = live_snapshot(spark, base)
    if live:
        create_table(spark, table, schema, location=live)
        _attach(spark, table, live)
    return live is not None


def _attach(spark: SparkSession, table: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {quoted(table)} SET{_located(location)}")
    spark.catalog.refreshTable(table)


def current_namespace(spark: SparkSession) -> str:
    return spark.sql("SHOW CURRENT NAMESPACE").first()["namespace"]


def table_names(spark: SparkSession, namespace: str) -> list[str]:
    tables = spark.sql(f"SHOW TABLES IN {quoted(namespace)}").filter(~F.col("isTemporary"))
    return sorted(row["tableName"] for row in tables.collect())


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.table(table)


def load_table(
    df: DataFrame, table: str, mode: str = "overwrite", table_format: str = "parquet", location: str | None = None
) -> None:
    """Replace or extend a whole table; an append matches columns by name."""
    writer = df.write.mode(mode).format(table_format)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def switch_snapshot(df: DataFrame, table: str, base: str, kept: int = KEPT_COPIES) -> None:
    """Replace a file table by a result that may read that same table.

    The new rows go to a numbered folder of their own; readers change over in one catalog update, and a failed write
    leaves the table as it was. The folder alone tells later sessions that it is the live one. The last ``kept`` finished
    folders stay, for queries that still read one of them.
    """
    spark = df.sparkSession
    last = max((number for number, _, _ in _snapshots(spark, base)), default=0)
    location = f"{base.rstrip('/')}/snapshot-{last + 1:06d}"
    df.write.parquet(location)
    if last + 1 not in [number for number, _, done in _snapshots(spark, base) if done]:
        raise RuntimeError(f"{location} has no {FINISHED}; mapreduce.fileoutputcommitter.marksuccessfuljobs must be on")
    _attach(spark, table, location)
    for _, old, _ in [s for s in _snapshots(spark, base) if s[0] <= last + 1 - kept]:
        files, place = folder(spark, old)
        files.delete(place, True)


def merge_into_table(source: DataFrame, table: str, on: str, update_when: Column, update_columns: list[str]) -> None:
    """MERGE for catalogs with row-level operations; ``merge_upsert`` is the form for plain files."""
    (
        source.alias("source")
        .mergeInto(table, F.col(f"{table}.{on}") == F.col(f"source.{on}"))
        .whenMatched(update_when)
        .update({c: F.col(f"source.{c}") for c in update_columns})
        .whenNotMatched()
        .insertAll()
        .merge()
    )
