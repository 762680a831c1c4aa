"""Parquet files and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Surrogate keys are hexadecimal digits, which Spark's default codec leaves at their full length.
CODEC = "zstd"


def read_parquet(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def write_parquet(df: DataFrame, base: str, name: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(f"{base.rstrip('/')}/{name}.parquet", compression=CODEC)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session without one gets a temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/starmart-{context.applicationId}"


def new_location(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has written to yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Cuts the lineage where a result is used several times; the files outlive any executor.
    """
    spark = df.sparkSession
    path = new_location(spark, name)
    df.write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path)
