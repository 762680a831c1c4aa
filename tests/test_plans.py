"""Shape of the physical plans."""

import pytest
from pyspark.sql import functions as F

from starmart.operators.scd2 import high_watermark, scd2_changes, stage_dimension
from starmart.plans.dimensions import CUSTOMER, PRODUCT, empty_dimension
from starmart.plans.staging import stage_order_items
from starmart.plans.facts import order_item_totals
from starmart.registry.queries import all_queries
from starmart.sources import retail
from starmart.sources.files import store
from tests.helpers import FLOOR, D, dim_customers, final_plan_of, plan_of, raw_customers

SF_DIR = "/root/testdata/sf0.001"
QUERIES = all_queries()


@pytest.mark.parametrize(
    "name",
    [
        "stg_orders",
        "stg_order_items",
        "stg_product",
        "scd2_delta_customer",
        "merge_dim_seller",
        "join_role_playing_dates",
        "pit_join_product",
        "fact_order_items",
        "fact_order_summary",
    ],
)
def test_no_single_task_and_no_pairs(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    # A total over one partial row per task is the only thing one task may gather.
    for gathered in plan.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate(keys=[], functions=[partial_" in gathered.splitlines()[1]
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan
    assert "Coalesce 1" not in plan


def test_dedup_limits_groups_on_both_sides_of_the_shuffle(spark):
    plan = plan_of(QUERIES["stg_orders"](spark, SF_DIR))
    above, below = plan.split("Exchange hashpartitioning(order_id")
    assert "row_number(), 1, Final" in above
    assert "row_number(), 1, Partial" in below


def test_totals_share_the_item_shuffle(spark, conf):
    """Dedup, join with the order and totals per order: one exchange of the items, one of the order dates."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    items = stage_order_items(retail.raw_order_items(spark, SF_DIR), retail.raw_orders(spark, SF_DIR), broadcast_bytes=0)
    plan = plan_of(order_item_totals(items))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" in plan


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(QUERIES["stg_orders"](spark, SF_DIR))
    columns = "o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz"
    assert f"ReadSchema: struct<{columns}>" in plan
    plan = plan_of(QUERIES["pit_join_customer"](spark, SF_DIR))
    columns = "customer_sk:string,customer_id:string,effective_from:date,effective_to:date,is_cur"
    assert f"ReadSchema: struct<{columns}" in plan


def test_filters_reach_the_scan(spark):
    assert "EqualTo(o_orderstatus,F)" in plan_of(QUERIES["filter_eq"](spark, SF_DIR))
    assert "In(o_orderstatus, [O,P])" in plan_of(QUERIES["filter_in"](spark, SF_DIR))
    assert "EqualTo(o_orderkey,7)" in plan_of(QUERIES["lookup_order"](spark, SF_DIR))
    assert "In(o_orderkey, [1,32,7])" in plan_of(QUERIES["lookup_orders"](spark, SF_DIR))
    batch = stage_dimension(PRODUCT, retail.raw_products(spark, SF_DIR, D(1998, 1, 1), D(1999, 1, 1)), F.lit(FLOOR))
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)" in plan_of(batch)


def test_watermark_reaches_the_scan_of_dated_sources(spark):
    raw = store(raw_customers(spark, [("a", "x", D(2020, 1, 5)), ("b", "x", None)]), "raw")
    plan = plan_of(stage_dimension(CUSTOMER, raw, F.lit(FLOOR)))
    assert "Or(GreaterThan(customer_updated_date,1999-12-31),And(IsNull(customer_updated_date)" in plan
    dimension = store(dim_customers(spark, [("k", "a", "x", D(2020, 1, 1), D(2020, 1, 6), False)]), "dim")
    staged = stage_dimension(CUSTOMER, raw, high_watermark(dimension, FLOOR).scalar())
    assert "DataFilters: [((customer_updated_date" in final_plan_of(staged)


def test_date_roles_join_by_hash(spark):
    plan = final_plan_of(QUERIES["join_role_playing_dates"](spark, SF_DIR)).split("== Initial Plan ==")[0]
    assert plan.count("BroadcastHashJoin") == 5
    assert plan.count("ReusedExchange") == 4


def test_facts_join_no_date_dimension(spark):
    plan = plan_of(QUERIES["fact_order_summary"](spark, SF_DIR))
    assert "datediff" in plan
    assert "week_of_year" not in plan


def test_small_changes_leave_the_target_unshuffled(spark):
    plan = final_plan_of(QUERIES["merge_dim_customer"](spark, SF_DIR))
    final = plan.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in final
    assert "Exchange hashpartitioning" not in final


def test_first_load_joins_nothing(spark):
    """An empty dimension drops out of the plan."""
    raw = store(raw_customers(spark, [("a", "x", D(2020, 1, 5))]), "raw")
    staged = stage_dimension(CUSTOMER, raw, F.lit(FLOOR))
    assert "Join" not in plan_of(scd2_changes(CUSTOMER, staged, empty_dimension(spark, CUSTOMER), D(2020, 2, 1)))
