"""Mixing sources to target weights by systematic sampling.

A document's expected copies are its source's target over its source's size. Within a source, in the order of size and
then of a hash, the expected copies are summed up, one random offset is added, and the document is emitted once for each
whole number that its interval crosses. Equal steps in the order of size make the words taken come near the target.

Targets share ``total`` times all words by weight and stop at ``most`` times the source's words; what is above goes to
the others by weight until none is above. That is one level ``x`` with targets ``min(x * weight, most * words)``,
found in closed form over the sources in the order of ``most * words / weight``.

DataFrame operations only. Defined results: a null text has no words; null is a source of its own, the last one; rows
are told apart by id and text, and equal rows are copies whose intervals follow each other; a very long text counts
whole; other columns are carried in a struct, so their names never clash; an empty table gives no rows; a source
without words takes nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.prefix import running_total
from starmart.llm.scratch import Scratch
from starmart.sources.files import store

WEIGHTS = (5, 2, 1)
SEED = "mix-1"


def n_spaced_words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; none in null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 12), 16, 10).cast("bigint") / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source``, ``source_size``, ``target`` for each source of the rows (``source``, ``size``)."""
    one = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    one = running_total(one, [], [F.asc_nulls_last("source")], F.lit(1).cast("bigint"), "_position")
    # Only the weights' ratios count; as whole numbers their sums don't depend on the order.
    parts = [Fraction(str(w)) for w in weights]
    whole = [Decimal(int(p * math.lcm(*[q.denominator for q in parts]))) for p in parts]
    weight = F.element_at(F.array(*[F.lit(w) for w in whole]), (F.col("_position") % len(whole) + 1).cast("int"))
    one = one.withColumn("_whole", weight.cast("decimal(20,0)")).withColumn("_weight", F.col("_whole").cast("double"))
    one = one.withColumn("_ratio", F.col("source_size") * F.lit(float(most)) / F.col("_weight"))
    lower = [F.col("_ratio"), F.asc_nulls_last("source")]
    one = running_total(one, [], lower, F.col("source_size"), "_size_below")
    one = running_total(one, [], lower, F.col("_whole"), "_weight_below")
    sums = one.agg(F.sum("source_size").alias("_sizes"), F.sum("_whole").alias("_weights"))
    one = one.crossJoin(F.broadcast(sums))
    left = F.col("_sizes") * F.lit(float(total)) - F.col("_size_below") * F.lit(float(most))
    one = one.withColumn("_own_level", left / (F.col("_weights") - F.col("_weight_below")).cast("double"))
    # The sources below the first one whose cap reaches the level are full.
    level = one.agg(F.max(F.when(F.col("_own_level") <= F.col("_ratio"), F.col("_own_level"))).alias("_level"))
    one = one.crossJoin(F.broadcast(level))
    target = F.least(F.coalesce("_level", "_ratio") * F.col("_weight"), F.col("source_size") * F.lit(float(most)))
    return one.select("source", "source_size", target.alias("target"))


def _copies(rows: DataFrame, order: Sequence[Column | str], seed: str) -> DataFrame:
    """Adds ``source_size``, ``target`` and ``copies`` to rows with ``source`` and ``size``."""
    targets = store(source_targets(rows.select("source", "size")), "mix_targets")
    ranked = running_total(rows, ["source"], order, F.lit(1).cast("bigint"), "_rank")
    own = targets.select(F.col("source").alias("_source"), "source_size", "target")
    ranked = ranked.join(own, F.col("source").eqNullSafe(F.col("_source")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _unit(F.lit(seed), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("null")))
    crossed = F.floor((F.col("_rank") + 1) * rate + offset) - F.floor(F.col("_rank") * rate + offset)
    return ranked.withColumn("copies", crossed.cast("bigint")).drop("_source", "_rank")


def mix_sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` of every document."""
    rows = store(docs.select("doc_id", "source", n_spaced_words(F.col("text")).alias("size")), "mix_sizes")
    return _copies(rows, ["size", F.md5(F.concat_ws("/", F.lit(seed), "doc_id")), F.asc_nulls_last("doc_id")], seed)


def digest(mixed: DataFrame) -> DataFrame:
    """One row of figures per document."""
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def mixed_documents(docs: DataFrame, seed: str = SEED, lent: Scratch | None = None) -> DataFrame:
    """The documents, each as often as it is emitted, columns as they were.

    ``lent`` takes the tables that the result still reads, to be released once it is stored.
    """
    scratch = Scratch()
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "source",
        F.xxhash64("text").alias("hash"),
        n_spaced_words(F.col("text")).alias("size"),
    )
    marked = scratch.store(marked, "mix_documents")
    tie = F.md5(F.concat_ws("/", F.lit(seed), "doc_id"))
    rows = marked.select("row", "doc_id", "source", "hash", "size")
    decided = _copies(rows, ["size", tie, F.asc_nulls_last("doc_id"), "hash", "row"], seed)
    emitted = decided.filter("copies > 0").select("row", "copies")
    if lent is not None:
        scratch.lend(lent)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return marked.select("row", "doc").join(emitted, "row").select("doc", copies.alias("copy")).select("doc.*")
