"""Retail source files derived from the TPC-H-like test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.keys import text_key_in
from starmart.operators.lookup import KeySketches, broadcast_size, hot_keys_unless_small, lookup_join


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _between(df: DataFrame, column: str, since: dt.date | None, until: dt.date | None) -> DataFrame:
    """Rows of a batch, filtered on the stored column so that the file scan takes the filter."""
    if since:
        df = df.filter(F.col(column) >= F.lit(since))
    if until:
        df = df.filter(F.col(column) < F.lit(until))
    return df


def _history(prefix: str, date: Column, never_updated: Column) -> list[Column]:
    """Creation and update date: rows never updated carry their date as the creation date only."""
    return [
        F.when(never_updated, date).otherwise(F.date_sub(date, 30)).alias(f"{prefix}_created_date"),
        F.when(~never_updated, date).alias(f"{prefix}_updated_date"),
    ]


def raw_orders(spark: SparkSession, sf_dir: str, order_ids: Sequence[str] | None = None) -> DataFrame:
    """Orders, or only those with these ids, which the file scan then looks up."""
    date, status = F.col("o_orderdate").cast("date"), F.col("o_orderstatus")
    stored = _table(spark, sf_dir, "orders")
    if order_ids is not None:
        stored = stored.filter(text_key_in("o_orderkey", order_ids))
    return stored.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        date.alias("order_purchase_date"),
        F.when(status != "O", F.date_add(date, 1)).alias("order_approved_at"),
        F.when(status != "O", F.date_add(date, 3)).alias("order_delivered_carrier_date"),
        F.when(status == "F", F.date_add(date, 7)).alias("order_delivered_customer_date"),
        F.date_add(date, 14).alias("order_estimated_delivery_date"),
        status.alias("order_status"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        F.col("l_quantity").cast("decimal(10,2)").alias("freight_value"),
        F.when(F.col("l_returnflag") != "R", F.col("l_shipdate").cast("date")).alias("shipping_limit_date"),
    )


# Sketches by application, source folder and number of tasks.
_sketches: dict[tuple[str, str, str], KeySketches] = {}


def item_sketches(spark: SparkSession, sf_dir: str) -> KeySketches:
    """The hot keys of lineitem for every join with it in a session: one pass over the table when the first needs it."""
    key = spark.sparkContext.applicationId, sf_dir, spark.conf.get("spark.sql.shuffle.partitions")
    made = KeySketches(_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_suppkey", "l_partkey"])
    return _sketches.setdefault(key, made)  # steps side by side get the same one; none has looked at the table yet


class Renamed(KeySketches):
    """Sketches of stored keys under other names, and as texts where the joined columns are the keys' texts."""

    def __init__(self, stored: KeySketches, names: dict[str, str], texts: bool):
        self._stored, self._names, self._texts = stored, names, texts

    def hot(self, key: str) -> dict[object, int]:
        found = self._stored.hot(self._names[key])
        return {str(item) if self._texts and item is not None else item: pieces for item, pieces in found.items()}


def order_item_sketches(spark: SparkSession, sf_dir: str) -> KeySketches:
    """The same for the raw and staged order items."""
    names = {"order_id": "l_orderkey", "seller_id": "l_suppkey", "product_id": "l_partkey"}
    return Renamed(item_sketches(spark, sf_dir), names, texts=True)


def _feed(facts: DataFrame, owners: DataFrame, sketches: KeySketches) -> DataFrame:
    """Facts with their owners' columns; a hot owner's facts are spread by the whole row, so copies of one spread too."""
    hot = hot_keys_unless_small(sketches, "key", broadcast_size(owners))
    return lookup_join(facts, owners, "key", "inner", hot, spread=facts.columns)


def _item_feed(spark: SparkSession, sf_dir: str, items: DataFrame, stored: str, owners: DataFrame) -> DataFrame:
    """A feed from line items whose ``key`` is the ``stored`` column."""
    return _feed(items, owners, Renamed(item_sketches(spark, sf_dir), {"key": stored}, texts=False))


def _with_nation(df: DataFrame, nation: DataFrame, nation_key: str) -> DataFrame:
    return df.join(nation, F.col(nation_key) == F.col("n_nationkey")).drop(nation_key, "n_nationkey")


def raw_customers(
    spark: SparkSession, sf_dir: str, since: dt.date | None = None, until: dt.date | None = None
) -> DataFrame:
    """Customer change feed: one row per order."""
    customers = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orders = _between(_table(spark, sf_dir, "orders"), "o_orderdate", since, until)
    owners = customers.select(F.col("c_custkey").alias("key"), "c_nationkey", "c_mktsegment")
    facts = orders.select(
        F.col("o_custkey").alias("key"), "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    feed = _feed(facts, _with_nation(owners, nation, "c_nationkey"), KeySketches(facts, ["key"]))
    return feed.select(
        F.col("key").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("customer_address"),
        F.col("n_name").alias("customer_state"),
        F.col("c_mktsegment").alias("customer_zip_code"),
        *_history("customer", F.col("o_orderdate").cast("date"), F.col("o_orderstatus") == "F"),
    )


def raw_sellers(
    spark: SparkSession, sf_dir: str, since: dt.date | None = None, until: dt.date | None = None
) -> DataFrame:
    """Seller change feed: one row per line item."""
    suppliers = _table(spark, sf_dir, "supplier")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    items = _between(_table(spark, sf_dir, "lineitem"), "l_shipdate", since, until)
    facts = items.select(
        F.col("l_suppkey").alias("key"), "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_linestatus"
    )
    owners = suppliers.select(F.col("s_suppkey").alias("key"), "s_nationkey")
    feed = _item_feed(spark, sf_dir, facts, "l_suppkey", _with_nation(owners, nation, "s_nationkey"))
    return feed.select(
        F.col("key").cast("string").alias("seller_id"),
        F.col("l_returnflag").alias("seller_address"),
        F.col("n_name").alias("seller_state"),
        F.col("l_linestatus").alias("seller_zip_code"),
        *_history("seller", F.col("l_shipdate").cast("date"), F.col("l_returnflag") == "R"),
    )


def raw_products(
    spark: SparkSession, sf_dir: str, since: dt.date | None = None, until: dt.date | None = None
) -> DataFrame:
    """Product change feed: one row per line item."""
    parts = _table(spark, sf_dir, "part")
    items = _between(_table(spark, sf_dir, "lineitem"), "l_shipdate", since, until)
    facts = items.select(
        F.col("l_partkey").alias("key"), "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_extendedprice"
    )
    owners = parts.select(F.col("p_partkey").alias("key"), "p_name", "p_type", "p_size")
    feed = _item_feed(spark, sf_dir, facts, "l_partkey", owners)
    size = F.col("p_size").cast("float")
    return feed.select(
        F.col("key").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("product_price"),
        F.col("p_size").cast("string").alias("product_size_label"),
        size.alias("product_length_cm"),
        size.alias("product_height_cm"),
        size.alias("product_width_cm"),
        *_history("product", F.col("l_shipdate").cast("date"), F.col("l_returnflag") == "R"),
    )
