"""The dimensions of the retail mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.config import Calendar
from starmart.functions.dates import UNKNOWN_DATE_KEY, calendar_columns, day_ordinal
from starmart.functions.keys import null_safe_eq
from starmart.operators.scd2 import DimensionSpec
from starmart.sources.contracts import DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, DIM_SELLER, conform

# Columns of the sources and their names in the mart.
CUSTOMER = DimensionSpec(
    table="dim_customer",
    source="customers",
    schema=DIM_CUSTOMER,
    key="customer_id",
    sk="customer_sk",
    attributes=("address", "state", "zip_code_prefix"),
    tracked=("address", "state", "zip_code_prefix"),
    updated="customer_updated_date",
    created="customer_created_date",
    renames={
        "customer_address": "address",
        "customer_state": "state",
        "customer_zip_code": "zip_code_prefix",
    },
)
SELLER = DimensionSpec(
    table="dim_seller",
    source="sellers",
    schema=DIM_SELLER,
    key="seller_id",
    sk="seller_sk",
    attributes=("address", "state", "zip_code_prefix"),
    tracked=("address", "state", "zip_code_prefix"),
    updated="seller_updated_date",
    created="seller_created_date",
    renames={
        "seller_address": "address",
        "seller_state": "state",
        "seller_zip_code": "zip_code_prefix",
    },
)
PRODUCT = DimensionSpec(
    table="dim_product",
    source="products",
    schema=DIM_PRODUCT,
    key="product_id",
    sk="product_sk",
    attributes=("product_name", "category_name", "price", "size_label", "length_cm", "height_cm", "width_cm"),
    tracked=("price", "category_name"),
    updated="product_updated_date",
    created="product_created_date",
    renames={
        "product_category": "category_name",
        "product_price": "price",
        "product_size_label": "size_label",
        "product_length_cm": "length_cm",
        "product_height_cm": "height_cm",
        "product_width_cm": "width_cm",
    },
)
SPECS = {spec.table: spec for spec in (CUSTOMER, SELLER, PRODUCT)}


def empty_dimension(spark: SparkSession, spec: DimensionSpec) -> DataFrame:
    """No versions yet; the constant filter lets the optimizer drop every join with it."""
    return spark.createDataFrame([], spec.schema).filter(F.lit(False))


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day from ``start_date`` to ``end_date`` of a one-row frame, both included."""
    start, end = F.col("start_date").cast("date"), F.col("end_date").cast("date")
    return bounds.select(start.alias("start_date"), F.explode(F.sequence(start, end)).alias("date"))


def date_dimension(bounds: DataFrame) -> DataFrame:
    """Date dimension over the days of a one-row frame, led by the unknown member."""
    date = F.col("date")
    days = date_spine(bounds).withColumns(
        {"date_key": day_ordinal(date, F.col("start_date")), **calendar_columns(date)}
    )
    blank = [None] * (len(DIM_DATE) - 1)
    unknown = bounds.sparkSession.createDataFrame([(UNKNOWN_DATE_KEY, *blank)], DIM_DATE)
    return unknown.unionByName(conform(days, DIM_DATE))


def calendar_bounds(spark: SparkSession, calendar: Calendar) -> DataFrame:
    return spark.createDataFrame(
        [(calendar.start.isoformat(), calendar.end.isoformat())], ["start_date", "end_date"]
    )


def calendar_dimension(spark: SparkSession, calendar: Calendar) -> DataFrame:
    return date_dimension(calendar_bounds(spark, calendar))


def attach_date_key(df: DataFrame, dates: DataFrame, column: str, key: str) -> DataFrame:
    """Date key by NULL-safe left join; ``dates`` has one row per calendar day, so its size is bounded."""
    role = dates.select(F.col("date").alias(f"_{key}_date"), F.col("date_key").alias(key))
    same_day = null_safe_eq(F.col(column), F.col(f"_{key}_date"))
    return df.join(F.broadcast(role), same_day, "left").drop(f"_{key}_date")
