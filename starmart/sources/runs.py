"""File tables that grow by runs: a folder for each run, and a catalog view over the finished ones.

A type 2 dimension keeps closed versions where the run that closed them wrote them, and a copy of the open versions for
each run:

    base/version=closed/run=000001, base/version=closed/run=000002, ...
    base/version=open/run=000002
    base/_finished/000001, base/_finished/000002

Its rows are all closed versions up to the last finished run and the open ones of that run. A run writes its open and newly
closed versions in one job; no file of an earlier run is read again to be written. Readers change over when the view is
replaced; the marker, written after the data, tells other sessions, and holds the latest ``effective_to`` of the dimension,
which the next run needs and which would take a scan of all closed versions. Leftovers of a run that failed are deleted by the
next one, which takes its number.

A fact keeps one folder for each processing date, ``base/run_date=2025-01-31``; the same date run again replaces it whole.
Below it are the rows that keep the contract (``accepted=true``) and those set aside.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart.sources.files import CODEC

# Folders below a dimension, and the flag they stand for.
OPEN, CLOSED = "open", "closed"
FINISHED = "_finished"
# Copies of the open versions that are left: the live one, and the one before it for queries that still read it.
KEPT_COPIES = 2
# A run's rows go to at most two folders: open and closed, accepted and set aside.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
# Whether a query deletes its shuffle files when it has ended.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Lets a task write to both folders of a run at once; otherwise Spark sorts all rows by folder first."""
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, str(max(2, int(before))))
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Lets queries delete their shuffle files as they end; otherwise all of a run's stay until the driver collects garbage."""
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(FILE_CLEANUP) if before is None else spark.conf.set(FILE_CLEANUP, before)


def folder(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    files, place = folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def _delete(spark: SparkSession, path: str) -> None:
    files, place = folder(spark, path)
    files.delete(place, True)


def quoted(name: str) -> str:
    """A table name of one or more parts for SQL text."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _show(spark: SparkSession, table: str, query: str) -> None:
    """Makes ``table`` a view of ``query``; readers see the old rows or the new ones."""
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        spark.sql(f"DROP TABLE {quoted(table)}")
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(table)} AS {query}")


def _files(base: str) -> str:
    return f"parquet.`{base.rstrip('/').replace('`', '``')}`"


def _columns_at_least(df: DataFrame, path: str) -> None:
    """A file without rows where a write has left none, so that the columns are known there."""
    files, place = folder(df.sparkSession, path)
    if not files.exists(place):
        df.limit(0).write.parquet(path)


# Dimensions


def last_run(spark: SparkSession, base: str) -> int:
    """Number of the last finished run of a dimension, 0 before the first."""
    return max((int(n) for n in _names(spark, f"{base}/{FINISHED}") if re.fullmatch(r"\d+", n)), default=0)


def kept_watermark(spark: SparkSession, base: str) -> dt.date | None:
    """The latest ``effective_to`` that the finished runs of a dimension have written, without a look at its rows."""
    run = last_run(spark, base)
    if not run:
        return None
    files, marker = folder(spark, f"{base}/{FINISHED}/{run:06d}")
    stream = files.open(marker)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return dt.date.fromisoformat(text) if text else None


def attach_versions(spark: SparkSession, table: str, base: str, schema: StructType) -> bool:
    """Shows the dimension at ``base`` as ``table``; False if no run has finished."""
    run = last_run(spark, base)
    if run:
        columns = [f"version = '{OPEN}' AS is_current" if c == "is_current" else quoted(c) for c in schema.names]
        live = f"version = '{CLOSED}' AND run <= {run} OR version = '{OPEN}' AND run = {run}"
        _show(spark, table, f"SELECT {', '.join(columns)} FROM {_files(base)} WHERE {live}")
    return run > 0


def write_versions(df: DataFrame, table: str, base: str, kept: int = KEPT_COPIES) -> None:
    """Finishes a run of a dimension: ``df`` has all open versions and those closed by this run.

    ``df`` may read the table itself.
    """
    spark, base = df.sparkSession, base.rstrip("/")
    run = last_run(spark, base) + 1
    for version in (OPEN, CLOSED):
        _delete(spark, f"{base}/version={version}/run={run:06d}")
    latest = Observation()
    versions = df.observe(latest, F.max("effective_to").alias("latest"))
    versions = versions.withColumn("version", F.when(F.col("is_current"), OPEN).otherwise(CLOSED)).drop("is_current")
    dealt = versions.withColumn("run", F.lit(f"{run:06d}")).write.mode("append").partitionBy("version", "run")
    dealt.parquet(base, compression=CODEC)
    _columns_at_least(df.drop("is_current"), f"{base}/version={OPEN}/run={run:06d}")
    ends = [d for d in (kept_watermark(spark, base), latest.get.get("latest")) if d]
    files, marker = folder(spark, f"{base}/{FINISHED}/{run:06d}")
    out = files.create(marker)
    out.writeBytes(max(ends).isoformat() if ends else "")
    out.close()
    attach_versions(spark, table, base, df.schema)
    for name in _names(spark, f"{base}/version={OPEN}"):
        number = re.fullmatch(r"run=(\d+)", name)
        if number and int(number[1]) <= run - kept:
            _delete(spark, f"{base}/version={OPEN}/{name}")


# Facts


def attach_days(spark: SparkSession, table: str, base: str, schema: StructType, quarantine: bool = False) -> bool:
    """Shows the fact at ``base`` as ``table``; False if no day has finished.

    With a ``quarantine``, the rows that broke the contract are ``<table>_quarantine``, with the columns they break it in
    and their processing date.
    """
    days = [n for n in _names(spark, base) if n.startswith("run_date=")]
    done = any("_SUCCESS" in _names(spark, f"{base}/{day}") for day in days)
    if done:
        columns = [f"CAST({quoted(f.name)} AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in schema.fields]
        _show(spark, table, f"SELECT {', '.join(columns)} FROM {_files(base)} WHERE accepted = 'true'")
        if quarantine:
            columns = [*map(quoted, schema.names), "broken", "run_date"]
            refused = f"SELECT {', '.join(columns)} FROM {_files(base)} WHERE accepted = 'false'"
            _show(spark, f"{table}_quarantine", refused)
    return done


def write_day(
    df: DataFrame, table: str, base: str, day: dt.date, schema: StructType, broken: Column | None = None
) -> dict[str, int]:
    """Puts the rows of a processing date in place of those that the date has, if any.

    ``broken`` is an array of the columns in which a row breaks the contract. Such rows are kept apart in the same write,
    which also counts them: the result has the number of rows for each column that any row breaks it in.
    """
    spark, place = df.sparkSession, f"{base.rstrip('/')}/run_date={day.isoformat()}"
    _delete(spark, place)
    nothing = F.array().cast("array<string>")
    rows = df.withColumn("broken", nothing if broken is None else broken)
    counts = Observation()
    counted = rows.observe(
        counts, *[F.count_if(F.array_contains("broken", c)).alias(c) for c in schema.names]
    )
    dealt = counted.withColumn("accepted", F.size("broken") == 0).write.mode("append").partitionBy("accepted")
    dealt.parquet(place, compression=CODEC)
    _columns_at_least(rows, f"{place}/accepted=true")
    attach_days(spark, table, base, schema, broken is not None)
    return {c: n for c, n in counts.get.items() if n}
