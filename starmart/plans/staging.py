"""Staged orders and order items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.dedup import keep_first
from starmart.operators.lookup import (
    BROADCAST_BYTES,
    VALUE_BYTES,
    KeySketches,
    broadcast_size,
    hot_keys_unless_small,
    lookup_join,
    with_likely_match,
)

# Columns of the sources, their staged names and order.
ORDER_RENAMES = {
    "order_purchase_date": "order_date",
    "order_approved_at": "order_approved_date",
    "order_delivered_carrier_date": "delivered_to_carrier_date",
    "order_delivered_customer_date": "delivered_to_customer_date",
    "order_estimated_delivery_date": "estimated_delivery_date",
}
ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "order_date",
    "order_approved_date",
    "delivered_to_carrier_date",
    "delivered_to_customer_date",
    "estimated_delivery_date",
    "order_status",
]
ITEM_COLUMNS = [
    "order_id",
    "order_item_id",
    "product_id",
    "seller_id",
    "item_value",
    "freight_value",
    "shipping_limit_date",
]


def stage_orders(raw_orders: DataFrame) -> DataFrame:
    """The earliest row per order by purchase date."""
    return keep_first(
        raw_orders.withColumnsRenamed(ORDER_RENAMES).select(*ORDER_COLUMNS), ["order_id"], ["order_date"]
    )


def order_dates(raw_orders: DataFrame) -> DataFrame:
    """Purchase date of the earliest row per order; a missing date is the earliest."""
    date = F.col("order_purchase_date")
    return raw_orders.groupBy("order_id").agg(
        F.when(F.count_if(date.isNull()) == 0, F.min(date)).alias("order_date")
    )


def stage_order_items(
    raw_items: DataFrame,
    raw_orders: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_in: KeySketches | None = None,
) -> DataFrame:
    """One row per order item, with the order date; items of unknown orders vanish.

    Both sides are reduced before they meet: the earliest order row and the lowest item row are also the lowest pair,
    and copies of an order never multiply the copies of its items. Unless some order is hot, the items are shuffled
    once, by order: that serves the deduplication, the join and later totals per order; most items of unknown orders are
    left out before. ``hot_in`` may have the hot orders already.
    """
    items = (
        raw_items.filter(F.col("order_id").isNotNull())
        .withColumnsRenamed({"price": "item_value"})
        .select(*ITEM_COLUMNS)
    )
    known = raw_orders.select("order_id", "order_purchase_date")
    size = broadcast_size(known)
    hot = hot_keys_unless_small(items if hot_in is None else hot_in, "order_id", size, broadcast_bytes)
    if hot is not None:
        items = with_likely_match(items, known, "order_id", size // (VALUE_BYTES * len(known.columns)), broadcast_bytes)
    if hot == {}:
        # With a number, Spark leaves the partitions as small as the session wants them, and their sort in memory.
        items = items.repartition(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), "order_id")
    items = keep_first(
        items,
        ["order_id", "order_item_id"],
        ["product_id", "seller_id", "item_value", "freight_value", "shipping_limit_date"],
    )
    dated = lookup_join(items, order_dates(raw_orders), "order_id", "inner", hot, spread=["order_item_id"])
    return dated.select(*ITEM_COLUMNS, "order_date")
