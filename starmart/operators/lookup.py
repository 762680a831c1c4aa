"""Joins of a large table with a smaller one that stay balanced under hot keys."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from threading import Lock

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

# A right side of up to so many bytes, as counted, goes to every executor; beyond it both sides are shuffled.
BROADCAST_BYTES = 16 << 20
# What a value takes besides the bytes of a text: its place in the row and in the hash table.
VALUE_BYTES = 16

# Entries that the heavy-hitter sketch tracks for each key that may be hot, and the most of one sketch. Where a key needs
# more, its values are dealt over several sketches. Keys that they miss join unsalted, with the same result.
TRACKED_PER_KEY = 40
MOST_TRACKED = 1_000_000

# Bits for each key that ``with_likely_match`` knows keys by, while they fit; below the second it leaves nothing out. Spark's
# bitmaps have 4 KB.
BITS_PER_KEY, FEWEST_BITS = 8, 1.5
BITMAP_BITS = 8 * 4096


def broadcast_size(df: DataFrame, copies: int = 1) -> int:
    """Bytes that the rows of ``df`` take in a broadcast, counted over its values; pass only the columns that are joined."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if isinstance(f.dataType, StringType)]
    row = sum(texts, F.lit(VALUE_BYTES * len(df.columns))).cast("bigint")
    return copies * (df.agg(F.sum(row)).first()[0] or 0)


@dataclass(frozen=True)
class KeySketch:
    """The most frequent values of a key, and how many rows it is of."""

    rows: int
    counts: dict[object, int]

    def hot(self, tasks: int) -> dict[object, int]:
        """Values with more rows than two of ``tasks`` equal shares, each with the number of pieces to cut it into.

        Fewer than ``tasks / 2`` values can qualify. NULL is one of them.
        """
        share = max(self.rows / tasks, 1)
        return {item: math.ceil(n / share) for item, n in self.counts.items() if n > 2 * share}


class KeySketches:
    """Sketches of several keys of a table, all made in one pass when the first of them is asked for."""

    def __init__(self, df: DataFrame, keys: Sequence[str], tasks: int | None = None):
        self._df, self._keys = df.select(*keys), tuple(keys)
        self.tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self._lock = Lock()
        self._found: dict[str, KeySketch] = {}

    def hot(self, key: str) -> dict[object, int]:
        with self._lock:
            if not self._found:
                self._found = _sketched(self._df, self._keys, self.tasks)
        return self._found[key].hot(self.tasks)


def _sketched(df: DataFrame, keys: Sequence[str], tasks: int) -> dict[str, KeySketch]:
    most = tasks // 2 + 1
    wanted = max(TRACKED_PER_KEY * most, 20_000)
    parts = -(-wanted // MOST_TRACKED)
    listed, tracked = min(most, MOST_TRACKED), min(wanted, MOST_TRACKED)

    def figures(key: str, part: int) -> list[Column]:
        # Each sketch sees the values of its part of the hashes; the others count as NULL, which it leaves out.
        mine = f"IF(pmod(xxhash64(`{key}`), {parts}) = {part}, `{key}`, NULL)" if parts > 1 else f"`{key}`"
        return [F.expr(f"approx_top_k({mine}, {listed}, {tracked})").alias(f"top_{key}_{part}")]

    nulls = [F.count_if(F.col(key).isNull()).alias(f"nulls_{key}") for key in keys]
    tops = [c for key in keys for part in range(parts) for c in figures(key, part)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *nulls, *tops).first()

    def counts(key: str) -> dict[object, int]:
        found = [e for part in range(parts) for e in row[f"top_{key}_{part}"] if e["item"] is not None]
        return {e["item"]: e["count"] for e in found} | {None: row[f"nulls_{key}"]}

    return {key: KeySketch(row["rows"], counts(key)) for key in keys}


def hot_keys(df: DataFrame, key: str, tasks: int) -> dict[object, int]:
    """The hot values of one key, by one pass over its column."""
    return KeySketches(df, [key], tasks).hot(key)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    residual: Column | None,
    spread: Sequence[str],
    hot: dict[object, int],
) -> DataFrame:
    """Equi-join in which each hot key is cut into pieces on the left and repeated per piece on the right.

    Left rows without a key match nothing and are only spread. The piece is a hash of the ``spread`` columns, never a
    random number, so a recomputed task puts every row where it was.
    """
    sizes = F.broadcast(
        left.sparkSession.createDataFrame(
            [(item, pieces) for item, pieces in hot.items() if item is not None],
            StructType([StructField(key, left.schema[key].dataType), StructField("_pieces", IntegerType())]),
        )
    )
    pieces = F.when(F.col(key).isNull(), hot.get(None, 1)).otherwise(F.coalesce("_pieces", F.lit(1)))
    cut = (
        left.join(sizes, key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), pieces).cast("int"))
        .drop("_pieces")
    )
    copies = (
        right.join(sizes, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)))
        .drop("_pieces")
    )
    joined = _equi_join(cut, copies, [key, "_salt"], how, residual)
    return joined.select(*left.columns, *[c for c in right.columns if c != key])


def _equi_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, residual: Column | None) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = [F.col(k) == F.col(f"_right_{k}") for k in keys]
    if residual is not None:
        condition.append(residual)
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def hot_keys_unless_small(
    left: DataFrame | KeySketches, key: str, right_bytes: int, broadcast_bytes: int = BROADCAST_BYTES
) -> dict[object, int] | None:
    """How to join ``left`` (or the table that has these sketches) with a right side of ``right_bytes``, for ``lookup_join``.

    None means that the right side is small enough to broadcast; otherwise the hot keys of ``left``, often none.
    """
    if right_bytes <= broadcast_bytes:
        return None
    sketches = left if isinstance(left, KeySketches) else KeySketches(left, [key])
    return sketches.hot(key)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    hot: dict[object, int] | None,
    *,
    spread: Sequence[str],
    residual: Column | None = None,
) -> DataFrame:
    """Inner or left join on ``key`` and ``residual``, a condition over column names that only one side has.

    ``hot`` comes from ``hot_keys_unless_small``. Which keys it holds changes the balance of the join, not its result.
    """
    if hot is None:
        return _equi_join(left, F.broadcast(right), [key], how, residual)
    if hot:
        return salted_join(left, right, key, how, residual, spread, hot)
    return _equi_join(left, right, [key], how, residual)


def with_likely_match(
    left: DataFrame, right: DataFrame, key: str, most_keys: int, most_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``left`` for an inner join with ``right``, without most of the rows that match nothing: they need no shuffle.

    Bitmaps of up to ``most_bytes`` of the hashes of right keys are broadcast. Every row that matches stays, and of the others
    one in eight or nine; with more than ``most_bytes`` for that many keys, more of them, in the end all.
    """
    bits = min(BITS_PER_KEY * most_keys, 8 * most_bytes)
    kinds = {left.schema[key].dataType, right.schema[key].dataType}
    if bits < FEWEST_BITS * most_keys or kinds not in ({StringType()}, {LongType()}, {IntegerType()}):
        return left
    bitmaps = max(1, -(-bits // BITMAP_BITS))
    number = F.pmod(F.xxhash64(key), F.lit(bitmaps * BITMAP_BITS))
    bitmap, bit = F.shiftright(number, 15), number.bitwiseAND(BITMAP_BITS - 1).cast("int")
    found = (
        right.filter(F.col(key).isNotNull())
        .select(bitmap.alias("_bitmap"), bit.alias("_bit"))
        .groupBy("_bitmap")
        .agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    )
    known = left.withColumns({"_number": bitmap, "_bit": bit}).join(
        F.broadcast(found), F.col("_number") == F.col("_bitmap")
    )
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright("_bit", 3) + 1, F.lit(1))), 16, 10).cast("int")
    return known.filter(F.getbit(byte, F.col("_bit").bitwiseAND(7)) == 1).select(*left.columns)
