"""Rules of the mart that are easy to get wrong, on hand-written rows."""

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.config import Calendar
from starmart.functions.dates import calendar_days, date_key
from starmart.functions.keys import any_differs, effective_update_date, null_safe_eq, surrogate_key, updated_after
from starmart.operators.dedup import keep_first
from starmart.operators.merge import merge_upsert
from starmart.operators.point_in_time import point_in_time_join
from starmart.operators.scd2 import (
    apply_changes,
    high_watermark,
    load_dimension,
    scd2_changes,
    scd2_expired,
    scd2_new,
    stage_dimension,
)
from starmart.plans.dimensions import CUSTOMER, PRODUCT, attach_date_key, calendar_dimension, empty_dimension
from starmart.plans.facts import fact_order_items, fact_order_summary
from starmart.plans.staging import stage_order_items, stage_orders
from starmart.sources.contracts import FACT_ORDER_SUMMARY, conform, enforce_contract
from starmart.sources.files import store
from tests.helpers import FLOOR, RAW_ITEM, RAW_ORDER, RAW_PRODUCT, D, dim_customers, raw_customers, rows_of

CALENDAR = Calendar(D(2020, 1, 1), D(2020, 12, 31))


def sk(key, date):
    return hashlib.sha256(f"{key}||{date.isoformat()}".encode()).hexdigest()


def load(spark, raw, dimension, as_of):
    return store(load_dimension(CUSTOMER, raw, dimension, as_of, FLOOR, store), "dim_customer")


# Staging


def test_earliest_pending_update_wins(spark):
    raw = raw_customers(spark, [("a", "new", D(2020, 3, 2)), ("a", "old", D(2020, 3, 1))])
    assert rows_of(stage_dimension(CUSTOMER, raw, F.lit(FLOOR)), "address", "updated_date") == [("old", D(2020, 3, 1))]


def test_rows_never_updated_use_their_creation_date(spark):
    raw = raw_customers(spark, [("a", "x", None)])
    staged = stage_dimension(CUSTOMER, raw, F.lit(FLOOR))
    assert rows_of(staged, "updated_date", "created_date") == [(D(2020, 1, 1), D(2020, 1, 1))]


def test_watermark_is_strict_and_floored(spark):
    open_only = dim_customers(spark, [("k", "a", "x", D(2020, 1, 1), None, True)])
    assert high_watermark(open_only, FLOOR).first()[0] == FLOOR
    closed = dim_customers(
        spark, [("k", "a", "x", D(2020, 1, 1), D(2020, 2, 9), False), ("l", "a", "y", D(2020, 2, 1), None, True)]
    )
    mark = high_watermark(closed, FLOOR).scalar()
    raw = raw_customers(spark, [("a", "z", D(2020, 2, 9)), ("b", "z", D(2020, 2, 10))])
    assert rows_of(stage_dimension(CUSTOMER, raw, mark), "customer_id") == [("b",)]


def test_late_rows_behind_the_watermark_are_dropped(spark):
    nothing = empty_dimension(spark, CUSTOMER)
    first = load(spark, raw_customers(spark, [("a", "x", D(2020, 1, 5))]), nothing, D(2020, 1, 6))
    second = load(spark, raw_customers(spark, [("a", "y", D(2020, 2, 5))]), first, D(2020, 3, 1))
    third = load(spark, raw_customers(spark, [("b", "x", D(2020, 2, 20))]), second, D(2020, 3, 2))
    assert rows_of(third, "customer_id").count(("b",)) == 0


@pytest.mark.parametrize("as_text", [False, True])
def test_update_date_as_date_or_text(spark, as_text):
    raw = raw_customers(spark, [("a", "x", D(2020, 1, 5)), ("b", "x", None)])
    if as_text:
        raw = raw.withColumn("customer_updated_date", F.col("customer_updated_date").cast("string"))
    names = ("customer_updated_date", "customer_created_date")
    dated = raw.withColumn("effective", effective_update_date(raw.schema, *names))
    assert rows_of(dated, "customer_id", "effective") == [("a", D(2020, 1, 5)), ("b", D(2020, 1, 1))]
    for watermark, kept in ((D(2019, 12, 31), ["a", "b"]), (D(2020, 1, 1), ["a"]), (D(2020, 1, 5), [])):
        fresh = raw.filter(updated_after(raw.schema, *names, F.lit(watermark)))
        assert rows_of(fresh, "customer_id") == [(k,) for k in kept]


def test_unreadable_update_date_fails(spark):
    raw = raw_customers(spark, [("a", "x", None)]).withColumn("customer_updated_date", F.lit("05/01/2020"))
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        stage_dimension(CUSTOMER, raw, F.lit(FLOOR)).collect()


def test_ties_are_settled_by_every_column(spark):
    rows = [(1, None, "b"), (1, None, "a"), (1, 2, "a"), (2, 5, "z")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    assert rows_of(keep_first(df, ["k"], ["t"])) == [(1, None, "a"), (2, 5, "z")]


def test_order_copies_do_not_multiply_items(spark):
    orders = spark.createDataFrame(
        [
            ("1", "c", D(2020, 1, 2), None, None, None, None, "F"),
            ("1", "c", D(2020, 1, 1), None, None, None, None, "O"),
        ],
        RAW_ORDER,
    )
    price = Decimal("1.00")
    items = spark.createDataFrame(
        [
            ("1", "1", "p", "s", price, price, None),
            ("1", "1", "o", "s", price, price, None),
            ("9", "1", "p", "s", price, price, None),
        ],
        RAW_ITEM,
    )
    for broadcast_bytes in (1 << 20, 0):
        staged = stage_order_items(items, orders, broadcast_bytes)
        assert rows_of(staged, "order_id", "product_id", "order_date") == [("1", "o", D(2020, 1, 1))]
    assert rows_of(stage_orders(orders), "order_date", "order_status") == [(D(2020, 1, 1), "O")]


def test_missing_purchase_date_is_the_earliest(spark):
    orders = spark.createDataFrame(
        [
            ("1", "c", D(2020, 1, 2), None, None, None, None, "F"),
            ("1", "c", None, None, None, None, None, "F"),
        ],
        RAW_ORDER,
    )
    items = spark.createDataFrame([("1", "1", "p", "s", None, None, None)], RAW_ITEM)
    assert rows_of(stage_orders(orders), "order_date") == [(None,)]
    assert rows_of(stage_order_items(items, orders), "order_date") == [(None,)]


# Versions


def test_new_and_closed_versions(spark):
    dimension = dim_customers(
        spark,
        [
            ("k1", "a", "old", D(2020, 1, 1), None, True),
            ("k2", "b", "same", D(2020, 1, 1), None, True),
            ("k3", "c", "gone", D(2020, 1, 1), None, True),
        ],
    )
    raw = raw_customers(
        spark, [("a", "new", D(2020, 5, 1)), ("b", "same", D(2020, 5, 1)), ("d", "first", D(2020, 5, 2))]
    )
    staged = stage_dimension(CUSTOMER, raw, F.lit(FLOOR))
    as_of = D(2020, 5, 3)
    opened = [
        (sk("a", D(2020, 5, 1)), "a", "new", "S", "Z", D(2020, 5, 1), None, True),
        (sk("d", D(2020, 5, 2)), "d", "first", "S", "Z", D(2020, 5, 2), None, True),
    ]
    closed = [("k1", "a", "old", "S", "Z", D(2020, 1, 1), D(2020, 5, 2), False)]
    assert rows_of(scd2_new(CUSTOMER, staged, dimension)) == sorted(opened, key=repr)
    assert rows_of(scd2_expired(CUSTOMER, staged, dimension, as_of)) == closed
    assert rows_of(scd2_changes(CUSTOMER, staged, dimension, as_of)) == sorted(opened + closed, key=repr)


@pytest.mark.parametrize(("old", "new"), [("x", None), (None, "x")])
def test_null_hides_a_change(spark, old, new):
    dimension = dim_customers(spark, [("k", "a", old, D(2020, 1, 1), None, True)])
    staged = stage_dimension(CUSTOMER, raw_customers(spark, [("a", new, D(2020, 5, 1))]), F.lit(FLOOR))
    assert scd2_changes(CUSTOMER, staged, dimension, D(2020, 5, 2)).count() == 0


def test_any_differs_is_three_valued(spark):
    rows = [(1, 1, 2, 3), (1, None, 2, 2), (1, None, 2, 3), (1, 1, 2, 2)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int")
    out = df.select(any_differs([(F.col("a"), F.col("b")), (F.col("c"), F.col("d"))]))
    assert [r[0] for r in out.collect()] == [True, None, True, False]


def product(spark, name, price, date):
    row = ("p", name, "cat", Decimal(price), "L", 1.0, 1.0, 1.0, D(2020, 1, 1), date)
    return spark.createDataFrame([row], RAW_PRODUCT)


def test_untracked_attributes_follow_tracked_ones(spark):
    def run(raw, dimension, as_of):
        return store(load_dimension(PRODUCT, raw, dimension, as_of, FLOOR, store), "dim_product")

    first = run(product(spark, "one", "1.00", D(2020, 2, 1)), empty_dimension(spark, PRODUCT), D(2020, 2, 2))
    renamed = run(product(spark, "two", "1.00", D(2020, 3, 1)), first, D(2020, 3, 2))
    assert rows_of(renamed, "product_name") == [("one",)]
    repriced = run(product(spark, "two", "2.00", D(2020, 4, 1)), renamed, D(2020, 4, 2))
    assert rows_of(repriced, "product_name", "effective_to") == [("one", D(2020, 4, 1)), ("two", None)]


def test_keys_missing_from_the_source_stay_current(spark):
    dimension = dim_customers(spark, [("k", "a", "x", D(2020, 1, 1), None, True)])
    loaded = load(spark, raw_customers(spark, [("b", "y", D(2020, 5, 1))]), dimension, D(2020, 5, 2))
    assert rows_of(loaded, "customer_id", "is_current") == [("a", True), ("b", True)]


def test_same_batch_twice_changes_nothing(spark):
    raw = raw_customers(spark, [("a", "x", D(2020, 5, 1)), ("b", "y", D(2020, 5, 1))])
    once = load(spark, raw, empty_dimension(spark, CUSTOMER), D(2020, 5, 2))
    assert rows_of(load(spark, raw, once, D(2020, 5, 3))) == rows_of(once)


def test_change_with_unchanged_update_date_is_ambiguous(spark):
    """The new version gets the key of the old one, so two source rows match one target row."""
    day = D(2020, 1, 5)
    dimension = dim_customers(spark, [(sk("a", day), "a", "x", day, None, True)])
    staged = stage_dimension(CUSTOMER, raw_customers(spark, [("a", "y", day)]), F.lit(FLOOR))
    changes = store(scd2_changes(CUSTOMER, staged, dimension, D(2020, 2, 1)), "changes")
    assert rows_of(changes, "customer_sk") == [(sk("a", day),)] * 2
    with pytest.raises(Exception, match="several source rows match"):
        apply_changes(CUSTOMER, dimension, changes).collect()


def test_key_with_closed_versions_only(spark):
    """It counts as new; if its surrogate key exists already, the merge leaves the closed row alone."""
    day = D(2020, 1, 5)
    dimension = dim_customers(spark, [(sk("a", day), "a", "x", day, D(2020, 2, 1), False)])
    for date, rows in ((D(2020, 3, 1), 2), (day, 1)):
        staged = stage_dimension(CUSTOMER, raw_customers(spark, [("a", "x", date)]), F.lit(FLOOR))
        changes = store(scd2_changes(CUSTOMER, staged, dimension, D(2020, 4, 1)), "changes")
        merged = apply_changes(CUSTOMER, dimension, changes)
        assert merged.count() == rows
        assert merged.filter("is_current").count() == rows - 1


def test_merge_upsert_rules(spark):
    schema = "sk string, v string, effective_to date, is_current boolean"
    target = spark.createDataFrame([("a", "1", None, True), ("b", "1", None, False), ("c", "1", None, True)], schema)
    source = spark.createDataFrame(
        [
            ("a", "2", D(2020, 1, 1), False),
            ("b", "2", D(2020, 1, 1), True),
            ("n", "2", None, True),
            ("n", "3", None, True),
            (None, "4", None, True),
        ],
        schema,
    )
    merged = merge_upsert(target, source, "sk", F.col("is_current"), ["effective_to", "is_current"])
    assert rows_of(merged) == sorted(
        [
            ("a", "1", D(2020, 1, 1), False),
            ("b", "1", None, False),
            ("c", "1", None, True),
            ("n", "2", None, True),
            ("n", "3", None, True),
            (None, "4", None, True),
        ],
        key=repr,
    )


# Facts


def point_in_time(spark, versions, dates):
    dimension = dim_customers(spark, versions)
    events = spark.createDataFrame([("a", d) for d in dates], "customer_id string, day date")
    out = point_in_time_join(events, dimension, "customer_id", "day", "customer_sk", spread=["day"])
    return rows_of(out, "day", "customer_sk")


@pytest.mark.parametrize(
    ("run", "expected"),
    [
        # Run the day after the update: versions meet.
        (
            D(2020, 6, 11),
            [(D(2020, 6, 8), "k1"), (D(2020, 6, 9), "k1"), (D(2020, 6, 10), "k2"), (D(2020, 6, 11), "k2")],
        ),
        # Run on the day of the update: the day before is uncovered.
        (
            D(2020, 6, 10),
            [(D(2020, 6, 8), "k1"), (D(2020, 6, 9), None), (D(2020, 6, 10), "k2"), (D(2020, 6, 11), "k2")],
        ),
        # Run days after the update: versions overlap and rows double.
        (
            D(2020, 6, 13),
            [
                (D(2020, 6, 8), "k1"),
                (D(2020, 6, 9), "k1"),
                (D(2020, 6, 10), "k1"),
                (D(2020, 6, 10), "k2"),
                (D(2020, 6, 11), "k1"),
                (D(2020, 6, 11), "k2"),
            ],
        ),
    ],
    ids=["day-after", "same-day", "later"],
)
def test_closing_date_follows_the_run(spark, run, expected):
    versions = [
        ("k1", "a", "x", D(2020, 1, 1), run - dt.timedelta(days=1), False),
        ("k2", "a", "y", D(2020, 6, 10), None, True),
    ]
    assert point_in_time(spark, versions, [D(2020, 6, d) for d in (8, 9, 10, 11)]) == sorted(expected, key=repr)


def test_event_before_the_first_version_has_no_key(spark):
    versions = [("k", "a", "x", D(2020, 2, 1), None, True)]
    assert point_in_time(spark, versions, [D(2020, 1, 1)]) == [(D(2020, 1, 1), None)]


def test_date_keys(spark):
    days = [None, D(2019, 12, 31), D(2020, 1, 1), D(2020, 12, 31), D(2021, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    dates = calendar_dimension(spark, CALENDAR)
    out = attach_date_key(df, dates, "day", "joined").withColumn("computed", date_key(F.col("day"), *calendar_days(CALENDAR)))
    want = [(day, key, key) for day, key in zip(days, [0, None, 1, 366, None], strict=True)]
    assert rows_of(out) == sorted(want, key=repr)


def test_null_safe_eq(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, None), (None, None)], "a int, b int")
    assert [r[0] for r in df.select(null_safe_eq(F.col("a"), F.col("b"))).collect()] == [True, False, False, True]


def test_calendar_attributes(spark):
    row = calendar_dimension(spark, CALENDAR).filter(F.col("date") == D(2020, 2, 29)).first().asDict()
    assert row == {
        "date_key": 60,
        "date": D(2020, 2, 29),
        "year": 2020,
        "month": 2,
        "day": 29,
        "day_of_week": 7,
        "week_of_year": 9,
        "quarter": 1,
        "day_of_year": 60,
        "is_month_end": True,
        "is_month_start": False,
        "is_weekend": True,
    }


def test_surrogate_key_skips_nulls(spark):
    df = spark.createDataFrame([("a", D(2020, 1, 5)), (None, D(2020, 1, 5))], "k string, d date")
    got = [r[0] for r in df.select(surrogate_key(F.col("k"), F.col("d"))).collect()]
    assert got == [sk("a", D(2020, 1, 5)), hashlib.sha256(b"2020-01-05").hexdigest()]


ORDER = ("1", "a", D(2020, 3, 1), D(2020, 3, 2), None, None, D(2021, 3, 1), "F")


def summary(spark, items):
    orders = stage_orders(spark.createDataFrame([ORDER], RAW_ORDER))
    staged = stage_order_items(spark.createDataFrame(items, RAW_ITEM), spark.createDataFrame([ORDER], RAW_ORDER))
    customers = dim_customers(spark, [("k", "a", "x", D(2020, 1, 1), None, True)])
    return fact_order_summary(orders, staged, customers, CALENDAR)


def test_order_without_items(spark):
    row = summary(spark, []).first().asDict()
    assert (row["customer_sk"], row["total_order_value"], row["item_count"]) == ("k", None, None)
    assert (row["order_date_key"], row["delivered_to_carrier_date_key"]) == (61, 0)
    assert (row["min_shipping_limit_date_key"], row["max_shipping_limit_date_key"]) == (0, 0)
    assert row["estimated_delivery_date_key"] is None
    with pytest.raises(Exception, match="NULL in NOT NULL column total_order_value"):
        enforce_contract(summary(spark, []), FACT_ORDER_SUMMARY).collect()


def test_totals(spark):
    items = [
        ("1", "1", "p", "s", Decimal("1.50"), Decimal("0.10"), D(2020, 3, 5)),
        ("1", "2", "p", "s", Decimal("2.50"), Decimal("0.20"), None),
        ("1", None, "p", "s", Decimal("3.00"), None, D(2020, 3, 4)),
    ]
    row = summary(spark, items).first().asDict()
    assert (row["total_order_value"], row["total_freight_value"]) == (Decimal("7.00"), Decimal("0.30"))
    assert row["item_count"] == 2
    assert (row["min_shipping_limit_date_key"], row["max_shipping_limit_date_key"]) == (64, 65)


def test_total_beyond_the_contract_fails(spark):
    items = [("1", str(n), "p", "s", Decimal("99999999.99"), Decimal("0.10"), None) for n in range(2)]
    assert summary(spark, items).first()["total_order_value"] == Decimal("199999999.98")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        conform(summary(spark, items), FACT_ORDER_SUMMARY).collect()


def test_item_fact(spark):
    orders = spark.createDataFrame([ORDER], RAW_ORDER)
    items = spark.createDataFrame([("1", "1", "p", "s", Decimal("1.50"), Decimal("0.10"), None)], RAW_ITEM)
    day = D(2020, 1, 1)
    validity = "effective_from date, effective_to date, is_current boolean"
    sellers = spark.createDataFrame([("sk", "s", day, None, True)], f"seller_sk string, seller_id string, {validity}")
    products = spark.createDataFrame([("pk", "q", day, None, True)], f"product_sk string, product_id string, {validity}")
    fact = fact_order_items(stage_order_items(items, orders), sellers, products, CALENDAR)
    assert rows_of(fact) == [("sk", None, "1", "1", Decimal("1.50"), Decimal("0.10"), 61, 0)]


def test_conform_reorders_by_name(spark):
    df = summary(spark, [])
    shuffled = df.select(*reversed(df.columns), F.lit(1).alias("extra"))
    assert conform(shuffled, FACT_ORDER_SUMMARY).columns == FACT_ORDER_SUMMARY.fieldNames()
