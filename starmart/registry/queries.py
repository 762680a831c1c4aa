"""Every operator as a query over the test tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.config import Calendar, MartConfig
from starmart.functions.dates import calendar_columns, calendar_days, date_key
from starmart.functions.keys import any_differs, effective_update_date, surrogate_key, updated_after
from starmart.operators.lookup import KeySketches, broadcast_size, hot_keys_unless_small, lookup_join
from starmart.operators.point_in_time import point_in_time_join
from starmart.operators.scd2 import (
    DimensionSpec,
    apply_changes,
    high_watermark,
    load_dimension,
    scd2_changes,
    scd2_expired,
    scd2_new,
    stage_dimension,
)
from starmart.plans.daily import run_daily
from starmart.plans.dimensions import (
    CUSTOMER,
    PRODUCT,
    SELLER,
    SPECS,
    attach_date_key,
    date_dimension,
    date_spine,
    empty_dimension,
)
from starmart.plans.facts import fact_order_items, fact_order_summary, order_item_totals
from starmart.plans.staging import ORDER_COLUMNS, ORDER_RENAMES, stage_order_items, stage_orders
from starmart.plans.together import together
from starmart.sources import retail
from starmart.sources.bucketed import bucketed_point_in_time_join, write_bucketed
from starmart.sources.contracts import DIM_PRODUCT, enforce_contract
from starmart.sources.files import new_location, read_parquet, shared_dir, store, write_parquet
from starmart.sources.runs import kept_watermark, write_versions
from starmart.sources.tables import create_namespace, create_table, load_table, read_table, table_names

Query = Callable[[SparkSession, str], DataFrame]

# The change feeds arrive in two batches that together cover every row.
FLOOR = dt.date(1994, 12, 31)
FIRST_RUN = dt.date(1998, 1, 1)
SECOND_RUN = dt.date(2002, 1, 1)

FEEDS = {
    "dim_customer": retail.raw_customers,
    "dim_seller": retail.raw_sellers,
    "dim_product": retail.raw_products,
}
SCRATCH = "starmart_scratch"


def _floor() -> Column:
    return F.lit(FLOOR)


def _staged_feed(spec: DimensionSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_dimension(spec, FEEDS[spec.table](spark, sf_dir), _floor())


def _first_load(spec: DimensionSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension after the first batch; into an empty dimension every change is an insert."""
    raw = FEEDS[spec.table](spark, sf_dir, until=FIRST_RUN)
    empty = empty_dimension(spark, spec)
    return store(scd2_changes(spec, stage_dimension(spec, raw, _floor()), empty, FIRST_RUN), spec.table)


def _second_raw(spec: DimensionSpec, spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Raw rows of the second batch, and the dimension they meet."""
    return together(
        partial(FEEDS[spec.table], spark, sf_dir, since=FIRST_RUN), partial(_first_load, spec, spark, sf_dir)
    )


def _second_batch(spec: DimensionSpec, spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw, dimension = _second_raw(spec, spark, sf_dir)
    return stage_dimension(spec, raw, high_watermark(dimension, FLOOR).scalar()), dimension


def _new(spec: DimensionSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_new(spec, *_second_batch(spec, spark, sf_dir))


def _expired(spec: DimensionSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_expired(spec, *_second_batch(spec, spark, sf_dir), SECOND_RUN)


def _delta(spec: DimensionSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_changes(spec, *_second_batch(spec, spark, sf_dir), SECOND_RUN)


def _merged(spec: DimensionSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    staged, dimension = _second_batch(spec, spark, sf_dir)
    changes = scd2_new(spec, staged, dimension).unionByName(scd2_expired(spec, staged, dimension, SECOND_RUN))
    return apply_changes(spec, dimension, store(changes, "changes"))


def _loaded(spec: DimensionSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_dimension(spec, *_second_raw(spec, spark, sf_dir), SECOND_RUN, FLOOR, store)


def _dimension(spec: DimensionSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    return store(_loaded(spec, spark, sf_dir), f"{spec.table}_loaded")


# Scans and sinks


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, sf_dir, "customer")


def roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_location(spark, "roundtrip")
    write_parquet(retail.raw_orders(spark, sf_dir), base, "orders")
    return read_parquet(spark, base, "orders")


def _scratch_table(spark: SparkSession, name: str) -> tuple[str, str]:
    create_namespace(spark, SCRATCH, f"{shared_dir(spark)}/{SCRATCH}")
    return f"{SCRATCH}.{name}_{uuid.uuid4().hex}", new_location(spark, name)


def table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, location = _scratch_table(spark, "overwritten")
    orders = retail.raw_orders(spark, sf_dir)
    load_table(orders, table, "overwrite", location=location)
    load_table(stage_orders(orders), table, "overwrite", location=location)
    return read_table(spark, table)


def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, the second with its columns reversed."""
    table, location = _scratch_table(spark, "appended")
    orders = retail.raw_orders(spark, sf_dir)
    create_table(spark, table, orders.schema, location=location)
    load_table(orders.filter(F.col("order_status") == "F"), table, "append", location=location)
    rest = orders.filter(F.col("order_status") != "F")
    load_table(rest.select(*reversed(rest.columns)), table, "append", location=location)
    return read_table(spark, table)


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, location = _scratch_table(spark, "items")
    load_table(retail.raw_order_items(spark, sf_dir), table, "overwrite", location=location)
    return read_table(spark, table).select("order_id", "order_item_id", "price")


def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged_feed(PRODUCT, spark, sf_dir)
    return enforce_contract(scd2_new(PRODUCT, staged, empty_dimension(spark, PRODUCT)), DIM_PRODUCT)


# Projections and predicates


def project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.raw_orders(spark, sf_dir).withColumnsRenamed(ORDER_RENAMES).select(*ORDER_COLUMNS)


def derive_updated_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update dates as text, the other form the source may have."""
    raw = retail.raw_customers(spark, sf_dir)
    raw = raw.withColumn(CUSTOMER.updated, F.col(CUSTOMER.updated).cast("string"))
    return raw.select(
        "customer_id",
        CUSTOMER.created,
        CUSTOMER.updated,
        effective_update_date(raw.schema, CUSTOMER.updated, CUSTOMER.created).alias("updated_date"),
    )


def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = retail.raw_customers(spark, sf_dir)
    watermark = F.lit(FIRST_RUN - dt.timedelta(days=1))
    return raw.filter(updated_after(raw.schema, CUSTOMER.updated, CUSTOMER.created, watermark)).select(
        "customer_id", "customer_address", CUSTOMER.created, CUSTOMER.updated
    )


def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.raw_orders(spark, sf_dir).filter(F.col("order_status") == "F")


def filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.raw_orders(spark, sf_dir).filter(F.col("order_status").isin(["O", "P"]))


def _orders_by_id(order_ids: list[str], spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail.raw_orders(spark, sf_dir, order_ids)


def scd2_changed_null_blind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change test per customer, with one address value of either side read as NULL."""
    staged, dimension = _second_batch(CUSTOMER, spark, sf_dir)
    s = staged.withColumn("address", F.nullif("address", F.lit("5-LOW"))).alias("s")
    d = dimension.withColumn("address", F.nullif("address", F.lit("1-URGENT"))).alias("d")
    changed = any_differs([(F.col(f"d.{c}"), F.col(f"s.{c}")) for c in CUSTOMER.tracked])
    return s.join(d, F.col("s.customer_id") == F.col("d.customer_id")).select(
        F.col("s.customer_id").alias("customer_id"), changed.alias("changed")
    )


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = surrogate_key(F.col("customer_id"), F.col("order_purchase_date"))
    return retail.raw_orders(spark, sf_dir).select("order_id", key.alias("customer_sk"))


def scalar_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = retail.raw_orders(spark, sf_dir).select("order_id", "order_purchase_date")
    return orders.withColumns(calendar_columns(F.col("order_purchase_date")))


# Staging


def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_orders(retail.raw_orders(spark, sf_dir))


def stg_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_order_items(
        retail.raw_order_items(spark, sf_dir),
        retail.raw_orders(spark, sf_dir),
        hot_in=retail.order_item_sketches(spark, sf_dir),
    )


# Joins and aggregates


def join_inner_items_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a raw item and a raw order row, copies of either included."""
    items, orders = retail.raw_order_items(spark, sf_dir), retail.raw_orders(spark, sf_dir)
    dates = orders.select("order_id", "order_purchase_date")
    hot = hot_keys_unless_small(retail.order_item_sketches(spark, sf_dir), "order_id", broadcast_size(dates))
    return lookup_join(items, dates, "order_id", "inner", hot, spread=items.columns)


def agg_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_item_totals(stg_order_items(spark, sf_dir))


def join_left_order_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stg_orders(spark, sf_dir).select("order_id", "order_date", "order_status")
    return orders.join(agg_order_items(spark, sf_dir), "order_id", "left")


def join_fullouter_scd(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged, dimension = _second_batch(CUSTOMER, spark, sf_dir)
    s, d = staged.alias("s"), dimension.alias("d")
    on = [F.col("s.customer_id") == F.col("d.customer_id"), F.col("d.is_current")]
    return s.join(d, on, "fullouter").select(
        F.col("s.customer_id").alias("staged_id"),
        F.col("d.customer_id").alias("dim_id"),
        F.col("s.address").alias("staged_address"),
        F.col("d.address").alias("dim_address"),
        F.col("s.updated_date").alias("updated_date"),
        F.col("d.effective_from").alias("effective_from"),
    )


ORDER_DATE_ROLES = {
    "order_date_key": "order_date",
    "order_approved_date_key": "order_approved_date",
    "delivered_to_carrier_date_key": "delivered_to_carrier_date",
    "delivered_to_customer_date_key": "delivered_to_customer_date",
    "estimated_delivery_date_key": "estimated_delivery_date",
}


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last calendar day of the years the orders and shipments fall in."""
    days = (
        retail.raw_orders(spark, sf_dir)
        .select(F.col("order_purchase_date").alias("day"))
        .union(spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_shipdate").cast("date")))
    )
    first, last = F.year(F.min("day")), F.year(F.max("day"))
    return days.agg(
        F.make_date(first, F.lit(1), F.lit(1)).alias("start_date"),
        F.make_date(last, F.lit(12), F.lit(31)).alias("end_date"),
    )


def _calendar(spark: SparkSession, sf_dir: str) -> Calendar:
    """The same days as a setting; one row comes to the driver."""
    return Calendar(*_order_days(spark, sf_dir).first())


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dimension(_order_days(spark, sf_dir))


def order_date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_spine(_order_days(spark, sf_dir)).select("date")


def join_null_safe_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = stg_orders(spark, sf_dir).select("order_id", "delivered_to_customer_date")
    return attach_date_key(orders, dim_date(spark, sf_dir), "delivered_to_customer_date", "date_key")


def join_role_playing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, dates = stg_orders(spark, sf_dir), dim_date(spark, sf_dir)
    for key, column in ORDER_DATE_ROLES.items():
        orders = attach_date_key(orders, dates, column, key)
    return orders.select("order_id", *ORDER_DATE_ROLES)


def date_key_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = retail.raw_orders(spark, sf_dir).withColumnsRenamed(ORDER_RENAMES)
    days = calendar_days(_order_days(spark, sf_dir))
    return orders.select("order_id", *[date_key(F.col(c), *days).alias(k) for k, c in ORDER_DATE_ROLES.items()])


def pit_join_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = retail.raw_orders(spark, sf_dir)
    orders = stage_orders(raw).select("order_id", "customer_id", "order_date")
    return point_in_time_join(
        orders,
        _dimension(CUSTOMER, spark, sf_dir),
        "customer_id",
        "order_date",
        "customer_sk",
        spread=["order_id"],
        hot_in=raw,
    )


def _pit_join_items(spec: DimensionSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    items, dimension = together(partial(stg_order_items, spark, sf_dir), partial(_dimension, spec, spark, sf_dir))
    return point_in_time_join(
        items.select("order_id", "order_item_id", spec.key, "order_date"),
        dimension,
        spec.key,
        "order_date",
        spec.sk,
        spread=["order_id", "order_item_id"],
        hot_in=retail.order_item_sketches(spark, sf_dir),
    )


def _pit_join_bucketed(spec: DimensionSpec, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from tables that are stored by the key of the dimension: no event of a usual key is shuffled."""
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if spec is CUSTOMER:
        raw = retail.raw_orders(spark, sf_dir)
        events = stage_orders(raw).select("order_id", spec.key, "order_date")
        hot_in, ids = KeySketches(raw, [spec.key], buckets), ["order_id"]
    else:
        events = stg_order_items(spark, sf_dir).select("order_id", "order_item_id", spec.key, "order_date")
        hot_in, ids = retail.order_item_sketches(spark, sf_dir), ["order_id", "order_item_id"]
    events, dimension = together(partial(store, events, "events"), partial(_loaded, spec, spark, sf_dir))
    dealt = write_bucketed(events, *_scratch_table(spark, "events"), spec.key, buckets, hot_in)
    versions = write_bucketed(dimension, *_scratch_table(spark, spec.table), spec.key, buckets)
    return bucketed_point_in_time_join(spark, dealt, versions, "order_date", spec.sk, spread=ids)


# Facts


def order_items_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, sellers, products = together(
        partial(stg_order_items, spark, sf_dir),
        *[partial(_dimension, spec, spark, sf_dir) for spec in (SELLER, PRODUCT)],
    )
    hot_in = retail.order_item_sketches(spark, sf_dir)
    return fact_order_items(items, sellers, products, _order_days(spark, sf_dir), hot_in=hot_in)


def order_summary_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, items, customers = together(
        partial(stg_orders, spark, sf_dir),
        partial(stg_order_items, spark, sf_dir),
        partial(_dimension, CUSTOMER, spark, sf_dir),
    )
    raw = retail.raw_orders(spark, sf_dir)
    return fact_order_summary(orders, items, customers, _order_days(spark, sf_dir), hot_in=raw)


def contiguous_summary_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: versions of a customer end where the next one begins."""
    orders, items, customers = together(
        partial(stg_orders, spark, sf_dir),
        partial(stg_order_items, spark, sf_dir),
        partial(_dimension, CUSTOMER, spark, sf_dir),
    )
    raw = retail.raw_orders(spark, sf_dir)
    return fact_order_summary(orders, items, customers, _order_days(spark, sf_dir), hot_in=raw, contiguous=True)


def stored_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermark that is kept with a stored dimension; its rows are not scanned for it."""
    base, name = new_location(spark, "dim_customer"), f"{SCRATCH}.dim_customer_{uuid.uuid4().hex}"
    create_namespace(spark, SCRATCH, f"{shared_dir(spark)}/{SCRATCH}")
    write_versions(_loaded(CUSTOMER, spark, sf_dir), name, base)
    latest = kept_watermark(spark, base) or FLOOR
    spark.sql(f"DROP VIEW {name}")
    return spark.range(1).select(F.lit(latest).alias("max_date"))


def watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_watermark(_loaded(CUSTOMER, spark, sf_dir), FLOOR)


# Reports


def _new_mart(
    spark: SparkSession, sf_dir: str, complete: bool = False, quarantine: bool = False
) -> MartConfig:
    """An empty mart with relaxed contracts.

    A ``complete`` one has strict contracts and unknown members for what is missing; with a ``quarantine``, facts that break
    the strict contracts are set aside.
    """
    base = new_location(spark, "mart")
    return MartConfig(
        inputs=sf_dir,
        staging=f"{base}/staging",
        warehouse=f"{base}/warehouse",
        namespace=f"starmart_{uuid.uuid4().hex}",
        calendar=_calendar(spark, sf_dir),
        floor_date=FLOOR,
        strict=complete or quarantine,
        unknown_members=complete,
        quarantine=quarantine,
    )


def _two_runs(cfg: MartConfig, spark: SparkSession, sf_dir: str, repeats: int = 1) -> None:
    """Two daily runs, one for each batch of the feeds and of the orders, each made so many times."""
    orders = retail.raw_orders(spark, sf_dir)
    early = F.coalesce(F.col("order_purchase_date") < F.lit(FIRST_RUN), F.lit(False))
    for as_of, span, batch in (
        (FIRST_RUN, {"until": FIRST_RUN}, early),
        (SECOND_RUN, {"since": FIRST_RUN}, ~early),
    ):
        raw = {SPECS[name].source: feed(spark, sf_dir, **span) for name, feed in FEEDS.items()}
        raw |= {"orders": orders.filter(batch), "order_items": retail.raw_order_items(spark, sf_dir)}
        for _ in range(repeats):
            run_daily(spark, cfg, as_of, raw)


# Marts after two daily runs, by application, source folder and options: a session's queries over one read the same.
_marts: dict[tuple[object, ...], MartConfig] = {}


def _stored_mart(spark: SparkSession, sf_dir: str, *, repeats: int = 1, **options: bool) -> MartConfig:
    """The mart after two daily runs, each made ``repeats`` times; the first query that asks for it makes it."""
    key = spark.sparkContext.applicationId, sf_dir, repeats, *sorted(options.items())
    if key not in _marts:
        cfg = _new_mart(spark, sf_dir, **options)
        _two_runs(cfg, spark, sf_dir, repeats)
        _marts[key] = cfg
    return _marts[key]


def _daily_table(table: str, spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    """A table of the mart after two daily runs."""
    return read_table(spark, _stored_mart(spark, sf_dir, **options).table(table))


def _quarantined(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows set aside in two daily runs, with the columns they break the contract in."""
    cfg = _stored_mart(spark, sf_dir, quarantine=True)
    rows = read_table(spark, f"{cfg.table(table)}_quarantine")
    return rows.withColumn("broken", F.array_join("broken", ","))


def _report(table: str, order_by: list[str], n: int, spark: SparkSession, sf_dir: str) -> DataFrame:
    """First rows of a stored table by SQL; the ids alone are not unique, so the order goes on."""
    cfg = _stored_mart(spark, sf_dir)
    return spark.sql(f"SELECT * FROM {cfg.table(table)} ORDER BY {', '.join(order_by)} LIMIT {n}")


def daily_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run of the mart over the whole feeds, then the rows of each table the catalog lists."""
    cfg = _new_mart(spark, sf_dir)
    raw = {
        **{SPECS[name].source: feed(spark, sf_dir) for name, feed in FEEDS.items()},
        "orders": retail.raw_orders(spark, sf_dir),
        "order_items": retail.raw_order_items(spark, sf_dir),
    }
    run_daily(spark, cfg, SECOND_RUN, raw)
    counts = [
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {cfg.table(name)}"
        for name in table_names(spark, cfg.namespace)
    ]
    return spark.sql(" UNION ALL ".join(counts))


def all_queries() -> dict[str, Query]:
    queries: dict[str, Query] = {
        "scan_parquet": scan_parquet,
        "roundtrip_parquet": roundtrip_parquet,
        "table_overwrite": table_overwrite,
        "table_append": table_append,
        "table_scan": table_scan,
        "contract_check": contract_check,
        "project_rename": project_rename,
        "derive_updated_date": derive_updated_date,
        "incremental_filter": incremental_filter,
        "filter_eq": filter_eq,
        "filter_in": filter_in,
        "scd2_changed_null_blind": scd2_changed_null_blind,
        "surrogate_key": surrogate_keys,
        "scalar_calendar": scalar_calendar,
        "stg_orders": stg_orders,
        "stg_order_items": stg_order_items,
        "join_inner_items_orders": join_inner_items_orders,
        "agg_order_items": agg_order_items,
        "join_left_order_agg": join_left_order_agg,
        "join_fullouter_scd": join_fullouter_scd,
        "date_spine": order_date_spine,
        "dim_date": dim_date,
        "join_null_safe_date": join_null_safe_date,
        "join_role_playing_dates": join_role_playing_dates,
        "date_key_arith": date_key_arith,
        "pit_join_customer": pit_join_customer,
        "pit_join_seller": partial(_pit_join_items, SELLER),
        "pit_join_product": partial(_pit_join_items, PRODUCT),
        "high_watermark": watermark,
        "stored_watermark": stored_watermark,
        "fact_order_items": order_items_fact,
        "fact_order_summary": order_summary_fact,
        "contiguous_fact_order_summary": contiguous_summary_fact,
        "topk_dim_date": partial(_report, "dim_date", ["date_key"], 5),
        "topk_fact_items": partial(
            _report, "fact_order_items", ["order_id", "order_item_id", "seller_sk", "product_sk"], 5
        ),
        "topk_fact_summary": partial(_report, "fact_order_summary", ["order_id", "customer_sk"], 10),
        "daily_run_counts": daily_run_counts,
        "daily_dim_date": partial(_daily_table, "dim_date"),
        "daily_fact_order_items": partial(_daily_table, "fact_order_items"),
        "daily_fact_order_summary": partial(_daily_table, "fact_order_summary"),
        "rerun_fact_order_items": partial(_daily_table, "fact_order_items", repeats=2),
        "rerun_fact_order_summary": partial(_daily_table, "fact_order_summary", repeats=2),
        "complete_fact_order_items": partial(_daily_table, "fact_order_items", complete=True),
        "complete_fact_order_summary": partial(_daily_table, "fact_order_summary", complete=True),
        "quarantined_order_items": partial(_quarantined, "fact_order_items"),
        "quarantined_order_summary": partial(_quarantined, "fact_order_summary"),
        "accepted_order_items": partial(_daily_table, "fact_order_items", quarantine=True),
        "lookup_order": partial(_orders_by_id, ["7"]),
        "lookup_orders": partial(_orders_by_id, ["7", "1", "32", "007", "no key"]),
    }
    for spec in SPECS.values():
        name = spec.table.removeprefix("dim_")
        queries |= {
            f"stg_{name}": partial(_staged_feed, spec),
            f"scd2_new_{name}": partial(_new, spec),
            f"scd2_expired_{name}": partial(_expired, spec),
            f"scd2_delta_{name}": partial(_delta, spec),
            f"merge_dim_{name}": partial(_merged, spec),
            f"dim_{name}_after_2_batches": partial(_loaded, spec),
            f"pit_join_{name}_bucketed": partial(_pit_join_bucketed, spec),
            f"daily_dim_{name}": partial(_daily_table, spec.table),
            f"complete_dim_{name}": partial(_daily_table, spec.table, complete=True),
            f"topk_dim_{name}": partial(_report, spec.table, [spec.key, "effective_from"], 5),
        }
    return queries
