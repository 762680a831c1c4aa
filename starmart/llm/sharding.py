"""Sharding by a two-pass external shuffle.

Pass one scatters: the shard is the highest of seeded hashes of (doc_id, shard number), so one more shard only takes rows
into itself, and within the shard a seeded hash of the whole row picks one of so many buckets that a bucket holds about
``BUCKET_BYTES``. Pass two loads one bucket at a time, puts it into a fixed order, Fisher-Yates shuffles it with a seed
of its own and writes it. A slot counts the rows of the shard's earlier buckets and those before it in its bucket.

Defined results: a null text has no bytes; null ids hash like any value, so they share a shard but not a bucket; rows
that share an id share its shard, equal rows get a slot each; a very long text makes its bucket longer; other columns are
carried in a struct, so their names never clash; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, MapType, StructField, StructType

from starmart.llm.common import packed
from starmart.sources.files import new_location

SEED = 20_260
# What one task holds at a time, of text; a hash keeps buckets near it.
BUCKET_BYTES = 16 << 20


def shard_of(doc_id: Column, shards: int, seed: int = SEED) -> Column:
    """The shard with the highest hash: of ids in one of n shards, n + 1 shards move only those that the new one takes."""
    draws = [F.struct(F.xxhash64(doc_id, F.lit(seed + s)).alias("h"), F.lit(s).alias("s")) for s in range(shards)]
    return F.greatest(*draws)["s"] if shards > 1 else F.lit(0)


def _shuffled(seed: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        shard, bucket = (int(k.as_py()) for k in key)
        rows = rows.combine_chunks()
        order = pc.sort_indices(rows, [("hash", "ascending"), ("size", "ascending"), ("crc", "ascending")]).to_numpy()
        # numpy's permutation is a Fisher-Yates shuffle.
        order = order[np.random.Generator(np.random.PCG64([seed, shard, bucket])).permutation(len(order))]
        place = pa.array(np.arange(len(order), dtype=np.int64))
        return rows.take(pa.array(order)).drop_columns(["hash", "crc", "size"]).append_column("place", place)

    return run


def write_shards(docs: DataFrame, shards: int = 8, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> str:
    """Writes the shuffled records as Parquet, a folder for each shard, and returns where."""
    spark = docs.sparkSession
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if not isinstance(f.dataType, MapType)]
    rows = packed(
        docs,
        shard_of(F.col("doc_id"), shards, seed).cast("int").alias("shard"),
        F.xxhash64(F.lit(seed), *hashed).alias("hash"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("bigint").alias("crc"),
    )
    per_shard = rows.groupBy("shard").agg(F.sum(F.col("size") + 64).alias("bytes"))
    largest = per_shard.agg(F.max("bytes")).first()[0] or 0
    buckets = max(1, -(-largest // bucket_bytes))
    rows = rows.withColumn("bucket", F.pmod("hash", F.lit(buckets)).cast("int"))
    fields = [StructField("shard", IntegerType()), StructField("bucket", IntegerType())]
    schema = StructType([rows.schema["doc"], *fields, StructField("place", LongType())])
    rows = rows.select("doc", "shard", "hash", "size", "crc", "bucket")
    path = new_location(spark, "shards")
    done = rows.groupBy("shard", "bucket").applyInArrow(_shuffled(seed), schema)
    done.write.partitionBy("shard").parquet(path)
    return path


def read_shards(docs: DataFrame, path: str) -> DataFrame:
    """Every written record: ``doc`` (all columns), ``shard``, ``bucket`` and ``place`` in the bucket."""
    schema = StructType(
        [
            StructField("doc", StructType(docs.schema.fields)),
            StructField("bucket", IntegerType()),
            StructField("place", LongType()),
            StructField("shard", IntegerType()),
        ]
    )
    return docs.sparkSession.read.schema(schema).parquet(path)


def with_slots(records: DataFrame) -> DataFrame:
    """Adds ``slot``, the place in the shard; pass only the columns that are needed, the rows are shuffled."""
    sizes = records.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    slots = records.join(starts, ["shard", "bucket"]).withColumn("slot", F.col("start") + F.col("place"))
    return slots.drop("bucket", "place", "start")


def digest(records: DataFrame, shards: int = 8, seed: int = SEED) -> DataFrame:
    """One row of figures per document, from the written records."""
    text = F.col("doc.text")
    figures = records.select(
        F.col("doc.doc_id").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        shard_of(F.col("doc.doc_id"), shards + 1, seed).cast("int").alias("grown_shard"),
        "bucket",
        "place",
    )
    return with_slots(figures)
