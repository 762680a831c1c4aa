"""Lloyd's clustering with the dimensions dealt out.

Vectors are cut into blocks of columns, and a packet is one block of one batch of vectors. In a round each packet gives its
exact partial distances to its slice of the centroids; a batch's partial distances are added up over the blocks and the
nearest centroid is taken; the batch's choices go back to its packets, and each block sums its own columns by cluster,
which gives its slice of the next centroids. No task needs more of a centroid than its block's slice, and nothing but
the centroids (``k`` times ``dims`` numbers) comes to the driver.

Packets are a table bucketed by batch, so that only partial distances and choices are shuffled, never the vectors. A round
reads that table and the centroids' numbers, so no lineage grows.

Everything is whole numbers: a component x is floor(1024 x), kept within 2**27 in size so that every distance fits
64 bits (|x| up to 131,072 is exact, beyond that it counts as that).

Defined results: vectors that are null, of another length, or with a null, NaN or infinite component are left out; equal
rows are vectors of their own; a null id hashes as ``null``; ids that tie in the first draw follow the order of their
components; fewer vectors than ``k`` give fewer centroids; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from starmart.llm.scratch import Scratch
from starmart.sources.files import new_location, store

SCALE = 1024
LARGEST = 1 << 27
BLOCK_DIMS = 32
# Sums of products below this are exact in doubles.
_EXACT = 1 << 53


@dataclass(frozen=True)
class Lloyd:
    """``k`` centroids over vectors of ``dims`` components, ``rounds`` of updates, ``seed`` of the first draw."""

    k: int = 8
    dims: int = 64
    rounds: int = 10
    seed: int = 3
    block_dims: int = BLOCK_DIMS

    @property
    def blocks(self) -> int:
        return -(-self.dims // self.block_dims)

    def columns(self, block: int) -> slice:
        return slice(block * self.block_dims, min((block + 1) * self.block_dims, self.dims))


def whole_numbers(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x.astype(np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int64)


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has ``dims`` components, all of them finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == dims) & finite, F.lit(False))


def _narrow(values: np.ndarray, kinds: str) -> np.ndarray:
    """The values in the first of the types that holds them."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    for kind in kinds:
        info = np.iinfo(kind)
        if info.min <= low and high <= info.max:
            return values.astype(f"<{np.dtype(kind).str[1:]}")
    raise OverflowError(f"{low} to {high}")


def _packed(values: np.ndarray, kinds: str) -> tuple[int, bytes]:
    out = _narrow(values, kinds)
    return out.itemsize, out.tobytes()


def _cut(plan: Lloyd, ids: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, batch in enumerate(b for b in batches if len(b)):
            values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, plan.dims)
            whole = whole_numbers(values)
            packets = [_packed(whole[:, plan.columns(b)], "hil") for b in range(plan.blocks)]
            first = pa.array([batch.column("vec_id").to_pylist()] + [None] * (plan.blocks - 1), pa.list_(ids))
            chunk = (batch.column("part")[0].as_py() << 33) + n
            columns = [
                pa.array([chunk] * plan.blocks, pa.int64()),
                pa.array(range(plan.blocks), pa.int32()),
                first,
                pa.array([size for size, _ in packets], pa.int32()),
                pa.array([data for _, data in packets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "block", "ids", "size", "data"])

    return run


def _table(df: DataFrame, keys: list[str]) -> tuple[str, str]:
    """``df`` as a table bucketed by ``keys``: its name and place."""
    spark = df.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name, path = f"packets_{uuid.uuid4().hex}", new_location(spark, "packets")
    dealt = df.repartition(buckets, *keys)
    dealt.write.option("path", path).format("parquet").bucketBy(buckets, *keys).saveAsTable(name)
    return name, path


def _values(cell: bytes, size: int, columns: int) -> np.ndarray:
    return np.frombuffer(cell, f"<i{size}").reshape(-1, columns)


def partial_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of every row to every centroid, exactly."""
    x = x.astype(np.int64)
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * top * top * x.shape[1] < _EXACT:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)


def _measure(plan: Lloyd, centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    slices = [centroids[:, plan.columns(b)] for b in range(plan.blocks)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = slices[row["block"]]
                size, data = _packed(partial_distances(_values(row["data"], row["size"], own.shape[1]), own), "IL")
                yield pa.RecordBatch.from_pylist([{"chunk": row["chunk"], "size": size, "data": data}], _PARTIAL)

    return run


_PARTIAL = pa.schema([("chunk", pa.int64()), ("size", pa.int32()), ("data", pa.binary())])
_CHOSEN = pa.schema([("chunk", pa.int64()), ("clusters", pa.binary()), ("distances", pa.binary())])


def _choose(k: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, packets: pa.Table) -> pa.Table:
        total: np.ndarray | None = None
        for row in packets.to_pylist():
            part = np.frombuffer(row["data"], f"<u{row['size']}").astype(np.int64).reshape(-1, k)
            total = part if total is None else total + part
        nearest = total.argmin(1)
        row = {"chunk": key[0].as_py(), "clusters": nearest.astype("<u4").tobytes()}
        row["distances"] = total[np.arange(len(total)), nearest].astype("<i8").tobytes()
        return pa.Table.from_pylist([row], schema=_CHOSEN)

    return run


def _chosen(packets: DataFrame, plan: Lloyd, centroids: np.ndarray) -> DataFrame:
    """Of each batch the clusters of its vectors and their distances."""
    partial = packets.select("chunk", "block", "size", "data")
    partial = partial.mapInArrow(_measure(plan, centroids), "chunk bigint, size int, data binary")
    return partial.groupBy("chunk").applyInArrow(
        _choose(len(centroids)), "chunk bigint, clusters binary, distances binary"
    )


def _sums(plan: Lloyd, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                block = row["block"]
                dims = plan.columns(block)
                x = _values(row["data"], row["size"], dims.stop - dims.start).astype(np.int64)
                own = held.setdefault(block, np.zeros((k, x.shape[1] + 1), np.int64))
                clusters = np.frombuffer(row["clusters"], "<u4")
                for c in np.unique(clusters):
                    mine = clusters == c
                    own[c, :-1] += x[mine].sum(0)
                    own[c, -1] += np.count_nonzero(mine)
        for block, own in held.items():
            first = plan.columns(block).start
            c, d = (index.ravel() for index in np.indices((k, own.shape[1] - 1)))
            columns = [c, d + first, own[:, :-1].ravel(), own[c, -1]]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=["cluster", "dim", "sum", "n"])

    return run


def _updated(packets: DataFrame, chosen: DataFrame, plan: Lloyd, centroids: np.ndarray) -> np.ndarray:
    """The next centroids; every block's columns are summed and divided by themselves."""
    own = packets.select("chunk", "block", "size", "data").join(
        chosen.select("chunk", "clusters").hint("shuffle_hash"), "chunk"
    )
    sums = own.mapInArrow(_sums(plan, len(centroids)), "cluster bigint, dim bigint, sum bigint, n bigint")
    sums = sums.groupBy("cluster", "dim").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n")).filter("n > 0")
    mean = F.expr("(sum - pmod(sum, n)) div n")
    out = centroids.copy()
    for cluster, dim, value in sums.select("cluster", "dim", mean).collect():
        out[cluster, dim] = value
    return out


def first_centroids(vectors: DataFrame, plan: Lloyd) -> np.ndarray:
    """The vectors with the lowest hashes of seed and id."""
    draw = F.sha2(F.concat(F.lit(f"{plan.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    rows = vectors.orderBy(draw, "vector").limit(plan.k).select("vector").collect()
    return whole_numbers(np.array([r[0] for r in rows], np.float64).reshape(-1, plan.dims))


def _unfolded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            ids = batch.column("ids")[i].values
            clusters = np.frombuffer(batch.column("clusters")[i].as_py(), "<u4").astype(np.int32)
            distances = np.frombuffer(batch.column("distances")[i].as_py(), "<i8")
            columns = [ids, pa.array(clusters), pa.array(distances)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])


def cluster(vectors: DataFrame, plan: Lloyd = Lloyd()) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``cluster`` and ``distance`` of every usable vector (``vec_id``, ``embedding``), and the centroids."""
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").alias("vector")).filter(usable(F.col("vector"), plan.dims))
    kind = rows.schema["vec_id"].dataType
    out = StructType([StructField("vec_id", kind), *StructType.fromDDL("cluster int, distance bigint").fields])
    centroids = first_centroids(rows, plan)
    if not len(centroids):
        return spark.createDataFrame([], out), centroids
    schema = StructType.fromDDL("chunk bigint, block int, ids array<int>, size int, data binary")
    schema.fields[2] = StructField("ids", ArrayType(kind))
    arrow_kind = _arrow_kind(rows)
    cut = rows.withColumn("part", F.spark_partition_id()).mapInArrow(_cut(plan, arrow_kind), schema)
    name, path = _table(cut, ["chunk"])
    scratch = Scratch()
    scratch.adopt(path)
    try:
        packets = spark.read.table(name)
        for _ in range(plan.rounds):
            centroids = _updated(packets, _chosen(packets, plan, centroids), plan, centroids)
        ids = packets.filter("block = 0").select("chunk", "ids")
        last = ids.join(_chosen(packets, plan, centroids).hint("shuffle_hash"), "chunk")
        return store(last.select("ids", "clusters", "distances").mapInArrow(_unfolded, out), "clusters"), centroids
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        scratch.release()


def _arrow_kind(rows: DataFrame) -> pa.DataType:
    return rows.select("vec_id").limit(0).toArrow().schema.field("vec_id").type


def digest(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds what each cluster and all of them sum up to, and a hash of each centroid."""
    sums = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())
    figures = {
        c: (int(total), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c, total in sums.items()
    }
    rows = [(c, inertia, sha) for c, (inertia, sha) in figures.items()]
    own = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, centroid_sha256 string")
    # One row for each cluster.
    out = found.join(F.broadcast(own), "cluster").withColumn("inertia", F.lit(sum(map(int, sums.values()))).cast("bigint"))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
