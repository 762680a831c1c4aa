"""Joins in which one key holds a third of all rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.operators import lookup
from starmart.operators.dedup import keep_first
from starmart.operators.lookup import hot_keys, hot_keys_unless_small, lookup_join
from starmart.operators.point_in_time import point_in_time_join
from starmart.plans.staging import stage_order_items
from starmart.sources import retail
from tests.helpers import D, final_plan_of, rows_of

SF_DIR = "/root/testdata/sf0.001"
ROWS = 6000
DAY = D(2020, 1, 1)


@pytest.fixture
def events(spark):
    """A third of the rows have key 0, a sixth none, the rest 500 keys in turn."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 0).when(n % 6 == 1, None).otherwise(1 + n % 500)
    return spark.range(ROWS).select(
        n.alias("event"), key.cast("string").alias("k"), F.date_add(F.lit(DAY), (n % 100).cast("int")).alias("day")
    )


@pytest.fixture
def versions(spark):
    """Up to three versions per key, some overlapping; every seventh key has none."""
    rows = []
    for key in range(501):
        if key and key % 7 == 0:
            continue
        rows.append((f"{key}-a", str(key), D(2020, 1, 11), D(2020, 2, 1), False))
        rows.append((f"{key}-b", str(key), D(2020, 1, 21), D(2020, 2, 11), False))
        rows.append((f"{key}-c", str(key), D(2020, 2, 11), None, True))
    schema = "sk string, k string, effective_from date, effective_to date, is_current boolean"
    return spark.createDataFrame(rows, schema)


def brute_force(events, versions):
    by_key = {}
    for sk, k, since, until, current in rows_of(versions):
        by_key.setdefault(k, []).append((sk, since, until, current))
    out = []
    for event, k, day in rows_of(events):
        found = [sk for sk, since, until, now in by_key.get(k, []) if day >= since and (now or day < until)]
        out += [(event, k, day, sk) for sk in found or [None]]
    return sorted(out, key=repr)


def test_hot_keys(events):
    hot = hot_keys(events, "k", 8)
    assert hot == {"0": 3}
    assert hot_keys(events, "k", 100) == {"0": 34, None: 17}
    assert hot_keys_unless_small(events, "k", 10, broadcast_bytes=10) is None
    assert hot_keys_unless_small(events, "k", 11, broadcast_bytes=10) == hot


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0], ids=["broadcast", "salted"])
def test_point_in_time_join(spark, conf, events, versions, broadcast_bytes):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="16")
    joined = point_in_time_join(events, versions, "k", "day", "sk", spread=["event"], broadcast_bytes=broadcast_bytes)
    assert joined.columns == ["event", "k", "day", "sk"]
    assert rows_of(joined) == brute_force(events, versions)


def test_any_choice_of_hot_keys_gives_the_same_rows(spark, conf, events, versions):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    right = versions.filter("is_current").select("k", "sk")
    for how in ("left", "inner"):
        want = rows_of(events.join(right, "k", how).select("event", "k", "sk"))
        for hot in (None, {}, {"0": 5}, {"0": 2, "3": 7, "absent": 4}, {None: 3}):
            got = lookup_join(events, right, "k", how, hot, spread=["event"])
            assert rows_of(got, "event", "k", "sk") == want


def test_hot_key_is_spread_over_tasks(spark, conf, events, versions):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    right = versions.filter("is_current").select("k", "sk")
    tasks = {}
    for hot in ({}, hot_keys(events, "k", 16)):
        joined = lookup_join(events, right, "k", "inner", hot, spread=["event"])
        sizes = joined.filter("k = '0'").groupBy(F.spark_partition_id()).count()
        tasks[bool(hot)] = [r["count"] for r in sizes.collect()]
    assert len(tasks[False]) == 1
    assert len(tasks[True]) > 3
    assert sum(tasks[True]) == sum(tasks[False])


@pytest.mark.parametrize("feed", [retail.raw_customers, retail.raw_sellers, retail.raw_products])
def test_feeds_by_every_join(spark, monkeypatch, feed):
    want = rows_of(feed(spark, SF_DIR))
    for hot in ({}, {1: 4, 5: 2, None: 2}):
        monkeypatch.setattr(retail, "hot_keys_unless_small", lambda *_, hot=hot: hot)
        assert rows_of(feed(spark, SF_DIR)) == want


def test_hot_group_collapses_before_the_shuffle(spark, events):
    plan = final_plan_of(keep_first(events, ["k"], ["day"]))
    assert "Partial" in plan.split("Exchange")[-1]
    assert "SinglePartition" not in plan


def test_items_of_a_hot_order(spark, conf, monkeypatch):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="16")
    n = F.col("id")
    order = F.when(n % 3 == 0, 0).otherwise(n % 700).cast("string")
    items = spark.range(ROWS).select(
        order.alias("order_id"),
        (n % 1000).cast("string").alias("order_item_id"),
        n.cast("string").alias("product_id"),
        F.lit("s").alias("seller_id"),
        F.lit(1).cast("decimal(10,2)").alias("price"),
        F.lit(2).cast("decimal(10,2)").alias("freight_value"),
        F.lit(None).cast("date").alias("shipping_limit_date"),
    )
    orders = spark.range(0, 1200).select(
        (n % 600).cast("string").alias("order_id"),
        F.date_add(F.lit(DAY), (n % 50).cast("int")).alias("order_purchase_date"),
    )
    dates, lowest = {}, {}
    for o, d in rows_of(orders):
        dates[o] = min(d, dates.get(o, dt.date.max))
    for o, i, p in rows_of(items, "order_id", "order_item_id", "product_id"):
        lowest[o, i] = min(p, lowest.get((o, i), "~"))
    want = sorted(((o, i, p, dates[o]) for (o, i), p in lowest.items() if o in dates), key=repr)
    for found in (lookup.hot_keys, lambda *_: {}):
        monkeypatch.setattr(lookup, "hot_keys", found)
        staged = stage_order_items(items, orders, broadcast_bytes=0)
        assert rows_of(staged, "order_id", "order_item_id", "product_id", "order_date") == want


def test_hot_keys_of_nothing(spark):
    nothing = spark.createDataFrame([], "k string")
    assert hot_keys(nothing, "k", 8) == {}
    blank = spark.createDataFrame([(None,)] * 20, "k string")
    assert hot_keys(blank, "k", 8) == {None: 8}
    dates = spark.createDataFrame([(DAY,)] * 20, "k date")
    assert hot_keys(dates, "k", 8) == {DAY: 8}


@pytest.mark.parametrize("most", [1_000_000, 700])
def test_sketches_of_all_keys_in_one_pass(spark, events, monkeypatch, most):
    """Also where a key needs more entries than one sketch has."""
    monkeypatch.setattr(lookup, "MOST_TRACKED", most)
    monkeypatch.setattr(lookup, "TRACKED_PER_KEY", 4)
    passes = []
    monkeypatch.setattr(lookup, "_sketched", lambda *a, real=lookup._sketched: passes.append(a) or real(*a))
    two = events.withColumn("other", F.when(F.col("event") % 2 == 0, 7).otherwise(F.col("event")))
    sketches = lookup.KeySketches(two, ["k", "other"], 100)
    assert sketches.hot("k") == {"0": 34, None: 17} and sketches.hot("other") == {7: 51}
    assert len(passes) == 1


def test_one_pass_over_lineitem_for_every_join(spark, conf, monkeypatch):
    """Nothing is broadcast: both feeds of both batches, the staged items and both as-of joins ask for hot keys."""
    from starmart.registry import queries

    passes = []
    monkeypatch.setattr(lookup, "_sketched", lambda df, *a, real=lookup._sketched: passes.append(df.columns) or real(df, *a))
    for module in (retail, queries, lookup):
        if hasattr(module, "broadcast_size"):
            monkeypatch.setattr(module, "broadcast_size", lambda *_: 1 << 40)
    monkeypatch.setattr("starmart.plans.staging.broadcast_size", lambda *_: 1 << 40)
    monkeypatch.setattr("starmart.operators.point_in_time.broadcast_size", lambda *_: 1 << 40)
    monkeypatch.setattr(retail, "_sketches", {})
    got = rows_of(queries.order_items_fact(spark, SF_DIR))
    assert [c for c in passes if "l_orderkey" in c] == [["l_orderkey", "l_suppkey", "l_partkey"]] == passes
    monkeypatch.undo()
    assert got == rows_of(queries.order_items_fact(spark, SF_DIR))


def test_copies_of_one_row_of_a_hot_key_spread(spark, conf):
    """All rows of the feed share seller, product and order; the whole row tells where each goes."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__coalescePartitions__enabled="false")
    conf(spark__sql__shuffle__partitions="16")
    facts = spark.range(4000).selectExpr("1L AS key", "5L AS l_orderkey", "1 AS l_linenumber", "id % 1000 AS l_extendedprice")
    owners = spark.createDataFrame([(1, "p")], "key bigint, p_name string")
    joined = lookup_join(facts, owners, "key", "inner", hot_keys(facts, "key", 16), spread=facts.columns)
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1400 and len(sizes) > 8


def test_size_of_a_broadcast(spark):
    frame = spark.createDataFrame([("abc", 1), (None, 2), ("é", None)], "k string, n int")
    assert lookup.broadcast_size(frame) == 3 * 2 * lookup.VALUE_BYTES + 3 + 2
    assert lookup.broadcast_size(frame.limit(0)) == 0
