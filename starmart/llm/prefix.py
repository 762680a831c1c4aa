"""Running totals over a global order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.sources.files import store


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], value: Column, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` (whole numbers) over the rows before this one among those with equal ``by``.

    Rows are range-partitioned by ``by`` and ``order`` and stored; the totals of the partitions (one row for each
    partition and ``by`` value in it) are summed in order, and rows within a partition by a window. The totals depend on
    the order only, not on where partitions begin. ``order`` should tell all unequal rows apart.
    """
    keys = [*[F.asc_nulls_last(b) for b in by], *order]
    dealt = df.withColumn("_value", value).repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    dealt = store(dealt, "running_total")
    totals = dealt.groupBy("_part", *by).agg(F.sum("_value").alias("_total"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    if by:
        before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_part").alias("_p"),
        *[F.col(b).alias(f"_by_{b}") for b in by],
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"),
    )
    here = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("_part") == F.col("_p")
    for b in by:
        same &= F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    return (
        dealt.withColumn("_within", F.coalesce(F.sum("_value").over(here), F.lit(0)))
        .join(offsets, same)
        .withColumn(out, F.col("_within") + F.col("_offset"))
        .drop("_value", "_part", "_within", "_offset", "_p", *[f"_by_{b}" for b in by])
    )
