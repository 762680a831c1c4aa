"""Small frames in the shape of the retail sources, and plan text."""

import datetime as dt

from starmart.operators.scd2 import DimensionSpec
from starmart.plans.dimensions import CUSTOMER, empty_dimension

D = dt.date
FLOOR = D(1999, 12, 31)

RAW_CUSTOMER = (
    "customer_id string, customer_address string, customer_state string, customer_zip_code string, "
    "customer_created_date date, customer_updated_date date"
)
RAW_PRODUCT = (
    "product_id string, product_name string, product_category string, product_price decimal(10,2), "
    "product_size_label string, product_length_cm float, product_height_cm float, product_width_cm float, "
    "product_created_date date, product_updated_date date"
)
RAW_ORDER = (
    "order_id string, customer_id string, order_purchase_date date, order_approved_at date, "
    "order_delivered_carrier_date date, order_delivered_customer_date date, order_estimated_delivery_date date, "
    "order_status string"
)
RAW_ITEM = (
    "order_id string, order_item_id string, product_id string, seller_id string, price decimal(10,2), "
    "freight_value decimal(10,2), shipping_limit_date date"
)


def raw_customers(spark, rows):
    """Rows of (id, address, updated); created ten days before, state and zip fixed."""
    full = [
        (i, address, "S", "Z", updated - dt.timedelta(days=10) if updated else D(2020, 1, 1), updated)
        for i, address, updated in rows
    ]
    return spark.createDataFrame(full, RAW_CUSTOMER)


def dim_customers(spark, rows, spec: DimensionSpec = CUSTOMER):
    """Rows of (sk, id, address, effective_from, effective_to, is_current)."""
    full = [(sk, i, address, "S", "Z", since, until, now) for sk, i, address, since, until, now in rows]
    schema = empty_dimension(spark, spec).schema
    for field in schema.fields:
        field.nullable = True
    return spark.createDataFrame(full, schema)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df) -> str:
    """Plan after adaptive execution; runs the query."""
    df.collect()
    return plan_of(df)
