"""Mart table schemas and their enforcement on write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


_PRICE = DecimalType(10, 2)


def _required(kind: DataType, *names: str) -> list[StructField]:
    return [StructField(name, kind, nullable=False) for name in names]


def _optional(kind: DataType, *names: str) -> list[StructField]:
    return [StructField(name, kind) for name in names]


# Names, types, order and NOT NULL marks of the mart tables.
_VALIDITY = [
    *_required(DateType(), "effective_from"),
    *_optional(DateType(), "effective_to"),
    *_required(BooleanType(), "is_current"),
]
DIM_CUSTOMER = StructType(
    _required(StringType(), "customer_sk", "customer_id", "address", "state", "zip_code_prefix") + _VALIDITY
)
DIM_SELLER = StructType(
    _required(StringType(), "seller_sk", "seller_id", "address", "state", "zip_code_prefix") + _VALIDITY
)
DIM_PRODUCT = StructType(
    _required(StringType(), "product_sk", "product_id", "product_name", "category_name")
    + _required(_PRICE, "price")
    + _required(StringType(), "size_label")
    + _required(FloatType(), "length_cm", "height_cm", "width_cm")
    + _VALIDITY
)
DIM_DATE = StructType(
    _optional(IntegerType(), "date_key")
    + _optional(DateType(), "date")
    + _optional(IntegerType(), "year", "month", "day", "day_of_week", "week_of_year", "quarter", "day_of_year")
    + _optional(BooleanType(), "is_month_end", "is_month_start", "is_weekend")
)
FACT_ORDER_ITEMS = StructType(
    _required(StringType(), "seller_sk", "product_sk", "order_id", "order_item_id")
    + _required(_PRICE, "item_value", "freight_value")
    + _required(IntegerType(), "order_date_key", "shipping_limit_date_key")
)
FACT_ORDER_SUMMARY = StructType(
    _required(StringType(), "customer_sk", "order_id", "order_status")
    + _required(_PRICE, "total_order_value", "total_freight_value")
    + _required(
        IntegerType(),
        "item_count",
        "order_date_key",
        "delivered_to_carrier_date_key",
        "delivered_to_customer_date_key",
        "estimated_delivery_date_key",
        "order_approved_date_key",
        "min_shipping_limit_date_key",
        "max_shipping_limit_date_key",
    )
)

TABLES = {
    "dim_customer": DIM_CUSTOMER,
    "dim_seller": DIM_SELLER,
    "dim_product": DIM_PRODUCT,
    "dim_date": DIM_DATE,
    "fact_order_items": FACT_ORDER_ITEMS,
    "fact_order_summary": FACT_ORDER_SUMMARY,
}

HISTORIES = ("dim_customer", "dim_seller", "dim_product")
FACTS = ("fact_order_items", "fact_order_summary")


def relaxed(schema: StructType) -> StructType:
    """The contract without its limits: NULLs anywhere, room for totals of any size."""
    wide = {DecimalType(10, 2): DecimalType(20, 2)}
    return StructType(
        [
            StructField(f.name, LongType() if f.name == "item_count" else wide.get(f.dataType, f.dataType))
            for f in schema.fields
        ]
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` by name, in its order, with checked narrowing casts (ANSI mode raises)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def enforce_contract(df: DataFrame, schema: StructType) -> DataFrame:
    """``conform`` that also fails the job when a NOT NULL column holds a NULL.

    Parquet tables accept NULLs in NOT NULL columns, so the check travels with the rows.
    """
    return conform(df, schema).select(
        *[
            F.col(f.name)
            if f.nullable
            else F.coalesce(
                F.col(f.name), F.raise_error(F.lit(f"NULL in NOT NULL column {f.name}")).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


def broken_columns(schema: StructType) -> Column:
    """Names of the columns in which a row breaks the contract: no value where one must be, or one that doesn't fit."""

    def broken(field: StructField) -> Column:
        value = F.col(field.name)
        lost = value.isNotNull() & value.try_cast(field.dataType).isNull()
        return lost if field.nullable else value.isNull() | lost

    return F.array_compact(F.array(*[F.when(broken(f), F.lit(f.name)) for f in schema.fields]))
