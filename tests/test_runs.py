"""Dimensions and facts kept by runs: what is rewritten, what a failed or repeated run leaves, unknown members."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators.merge import merge_upsert
from starmart.operators.point_in_time import point_in_time_join
from starmart.operators.scd2 import UNKNOWN_SK
from starmart.plans import daily
from starmart.plans.daily import run_daily
from starmart.sources.contracts import DIM_CUSTOMER
from starmart.sources.files import write_parquet
from starmart.sources.runs import attach_versions, kept_watermark, last_run, quoted, write_versions
from starmart.sources.tables import ensure_tables, read_table
from tests.helpers import RAW_ITEM, RAW_ORDER, D, dim_customers, plan_of, rows_of
from tests.test_mart import config, write_sources

DAYS = [D(2020, 2, 1), D(2020, 3, 1), D(2020, 4, 1)]


def files_below(place):
    """Every data file with what tells a rewritten one."""
    return {
        str(f.relative_to(place)): (f.stat().st_ino, f.stat().st_mtime_ns)
        for f in place.rglob("*.parquet")
        if "_temporary" not in str(f)
    }


def test_closed_versions_are_never_written_again(spark, tmp_path):
    """Each run adds its closed versions and a copy of the open ones, whatever the history holds."""
    cfg = config(tmp_path, "closed")
    place = tmp_path / "warehouse" / "dim_customer"
    before = {}
    for n, day in enumerate(DAYS, 1):
        write_sources(spark, cfg, f"address {n}", day, [str(n)])
        run_daily(spark, cfg, day + dt.timedelta(days=1))
        now = files_below(place)
        closed = {f: stat for f, stat in before.items() if f.startswith("version=closed")}
        assert closed == {f: now[f] for f in closed}
        fresh = {f.split("/")[0] + "/" + f.split("/")[1] for f in now if f not in before}
        assert fresh <= {f"version=open/run={n:06d}", f"version=closed/run={n:06d}"}
        before = now
    assert len([f for f in before if f.startswith("version=closed")]) == 2
    assert {f.split("/")[1] for f in before if f.startswith("version=open")} == {"run=000002", "run=000003"}
    customers = read_table(spark, cfg.table("dim_customer"))
    assert rows_of(customers, "address", "effective_to", "is_current") == [
        ("address 1", D(2020, 3, 1), False),
        ("address 2", D(2020, 4, 1), False),
        ("address 3", None, True),
    ]
    assert spark.catalog.getTable(cfg.table("dim_customer")).tableType == "VIEW"


def test_current_versions_are_read_without_history(spark, tmp_path):
    cfg = config(tmp_path, "pruned")
    for n, day in enumerate(DAYS[:2], 1):
        write_sources(spark, cfg, f"address {n}", day, [str(n)])
        run_daily(spark, cfg, day + dt.timedelta(days=1))
    current = read_table(spark, cfg.table("dim_customer")).filter("is_current")
    assert all("version=open/run=000002" in f for f in _read_files(current))
    assert "PartitionFilters: [isnotnull" in plan_of(current) or "PartitionFilters: [(" in plan_of(current)


def _read_files(df):
    return [r[0] for r in df.select(F.input_file_name()).distinct().collect()]


def test_a_failed_run_leaves_the_dimension_and_is_cleared_by_the_next(spark, tmp_path):
    cfg = config(tmp_path, "cleared")
    ensure_tables(spark, cfg)
    base, table = cfg.folder("dim_customer"), cfg.table("dim_customer")
    write_versions(dim_customers(spark, [("k", "a", "x", D(2020, 1, 1), None, True)]), table, base)
    both = [("k", "a", "x", D(2020, 1, 1), D(2020, 2, 1), False), ("l", "a", "y", D(2020, 2, 2), None, True)]
    broken = dim_customers(spark, both).withColumn(
        "state", F.when(F.col("is_current"), F.raise_error(F.lit("broken"))).otherwise(F.col("state"))
    )
    with pytest.raises(Exception, match="broken"):
        write_versions(broken, table, base)
    assert rows_of(read_table(spark, table), "customer_sk") == [("k",)] and last_run(spark, base) == 1
    # What a run leaves that ended between its files and its marker.
    stray = dim_customers(spark, [("stray", "a", "x", D(2020, 1, 1), None, True)]).drop("is_current")
    for version in ("open", "closed"):
        stray.write.mode("overwrite").parquet(f"{base}/version={version}/run=000002")
    assert rows_of(read_table(spark, table), "customer_sk") == [("k",)]
    spark.sql(f"DROP VIEW {table}")
    ensure_tables(spark, cfg)
    assert rows_of(read_table(spark, table), "customer_sk") == [("k",)]
    write_versions(dim_customers(spark, both), table, base)
    assert rows_of(read_table(spark, table), "customer_sk", "is_current") == [("k", False), ("l", True)]


def test_an_empty_dimension_can_be_kept(spark, tmp_path):
    cfg = config(tmp_path, "empty_runs")
    ensure_tables(spark, cfg)
    base, table = cfg.folder("dim_customer"), cfg.table("dim_customer")
    assert not attach_versions(spark, table, base, DIM_CUSTOMER)
    write_versions(dim_customers(spark, []), table, base)
    found = read_table(spark, table)
    assert found.columns == DIM_CUSTOMER.names and found.count() == 0


def mart_rows(spark, cfg):
    names = ("dim_customer", "dim_seller", "dim_product", "dim_date", "fact_order_items", "fact_order_summary")
    return {n: rows_of(read_table(spark, cfg.table(n))) for n in names}


def test_the_same_day_may_run_again(spark, tmp_path):
    cfg = config(tmp_path, "again")
    for n, day in enumerate(DAYS[:2], 1):
        write_sources(spark, cfg, f"address {n}", day, [str(2 * n), str(2 * n + 1)])
        run_daily(spark, cfg, day + dt.timedelta(days=1))
        once = mart_rows(spark, cfg)
        run_daily(spark, cfg, day + dt.timedelta(days=1))
        assert mart_rows(spark, cfg) == once
    assert len(once["fact_order_summary"]) == 4 and len(once["fact_order_items"]) == 8


@pytest.mark.parametrize("broken", ["load_order_items", "load_order_summary"])
def test_a_run_may_be_repeated_after_one_fact_failed(spark, tmp_path, monkeypatch, broken):
    cfg = config(tmp_path, f"half_{broken}")
    write_sources(spark, cfg, "address 1", DAYS[0], ["1", "2"])
    run_daily(spark, cfg, DAYS[0])
    write_sources(spark, cfg, "address 2", DAYS[1], ["3"])

    def fail(*_):
        raise RuntimeError("fact failed")

    with monkeypatch.context() as patch:
        patch.setattr(daily, broken, fail)
        with pytest.raises(RuntimeError, match="fact failed"):
            run_daily(spark, cfg, DAYS[1])
    run_daily(spark, cfg, DAYS[1])
    rows = mart_rows(spark, cfg)
    assert len(rows["fact_order_summary"]) == 3 and len(rows["fact_order_items"]) == 6
    days = sorted(p for p in os.listdir(tmp_path / "warehouse" / "fact_order_items") if "=" in p)
    assert days == [f"run_date={d}" for d in DAYS[:2]]


def test_a_rerun_without_rows_empties_its_day(spark, tmp_path):
    cfg = config(tmp_path, "emptied")
    write_sources(spark, cfg, "address 1", DAYS[0], ["1"])
    run_daily(spark, cfg, DAYS[0])
    write_sources(spark, cfg, "address 1", DAYS[0], [])
    run_daily(spark, cfg, DAYS[0])
    rows = mart_rows(spark, cfg)
    assert rows["fact_order_items"] == rows["fact_order_summary"] == []


def test_unknown_members_keep_a_strict_run_whole(spark, tmp_path):
    cfg = config(tmp_path, "unknown", unknown_members=True)
    write_sources(spark, cfg, "first", D(2020, 2, 1), ["1"])
    # An order of nobody, beyond the calendar and without items; an item of no seller and no product.
    stray = [("9", "nobody", D(2021, 6, 1), None, None, None, None, "O")]
    write_parquet(spark.createDataFrame(stray, RAW_ORDER), cfg.inputs, "orders", "append")
    item = [("1", "3", "nothing", None, Decimal("2.00"), Decimal("1.00"), None)]
    write_parquet(spark.createDataFrame(item, RAW_ITEM), cfg.inputs, "order_items", "append")
    for _ in range(2):
        run_daily(spark, cfg, D(2020, 2, 2))
        summary = read_table(spark, cfg.table("fact_order_summary")).filter("order_id = '9'").collect()
        assert [tuple(r) for r in summary] == [(UNKNOWN_SK, "9", "O", Decimal(0), Decimal(0), 0, 0, 0, 0, 0, 0, 0, 0)]
        items = read_table(spark, cfg.table("fact_order_items")).filter("order_item_id = '3'")
        assert rows_of(items, "seller_sk", "product_sk", "shipping_limit_date_key") == [(UNKNOWN_SK, UNKNOWN_SK, 0)]
        # Every surrogate key finds one version.
        for table, key in (("dim_customer", "customer_sk"), ("dim_seller", "seller_sk"), ("dim_product", "product_sk")):
            reserved = read_table(spark, cfg.table(table)).filter(F.col(key) == UNKNOWN_SK)
            assert rows_of(reserved, "is_current", "effective_from") == [(True, cfg.floor_date)]


def test_broken_rows_are_counted_and_set_aside_in_one_write(spark, tmp_path, caplog):
    cfg = config(tmp_path, "quarantine", quarantine=True)
    write_sources(spark, cfg, "first", D(2020, 2, 1), ["1", "2"])
    stray = [("9", "nobody", D(2020, 2, 1), None, None, None, None, "O")]
    write_parquet(spark.createDataFrame(stray, RAW_ORDER), cfg.inputs, "orders", "append")
    huge = [("1", str(n), "p1", "s1", Decimal("99999999.99"), Decimal("1.00"), None) for n in range(5, 7)]
    write_parquet(spark.createDataFrame(huge, RAW_ITEM), cfg.inputs, "order_items", "append")
    for _ in range(2):
        caplog.clear()
        run_daily(spark, cfg, D(2020, 2, 2))
        summary = read_table(spark, cfg.table("fact_order_summary"))
        assert rows_of(summary, "order_id", "total_order_value") == [("2", Decimal("10.00"))]
        assert dict(summary.dtypes)["total_order_value"] == "decimal(10,2)" and dict(summary.dtypes)["item_count"] == "int"
        refused = read_table(spark, cfg.table("fact_order_summary") + "_quarantine")
        assert rows_of(refused, "order_id", "total_order_value", "broken", "run_date") == [
            ("1", Decimal("200000009.98"), ["total_order_value"], D(2020, 2, 2)),
            ("9", None, ["customer_sk", "total_order_value", "total_freight_value", "item_count"], D(2020, 2, 2)),
        ]
        counts = {"customer_sk": 1, "total_order_value": 2, "total_freight_value": 1, "item_count": 1}
        assert str(counts) in caplog.text
        assert read_table(spark, cfg.table("fact_order_items")).count() == 6
    spark.sql(f"DROP VIEW {cfg.table('fact_order_summary')}_quarantine")
    ensure_tables(spark, cfg)
    assert read_table(spark, cfg.table("fact_order_summary") + "_quarantine").count() == 2


@pytest.mark.parametrize("options", [{"strict": False}, {"table_format": "iceberg"}])
def test_quarantine_is_for_strict_file_tables(tmp_path, options):
    with pytest.raises(ValueError, match="quarantine"):
        config(tmp_path, "no_quarantine", quarantine=True, **options)


def test_watermark_is_kept_with_the_runs(spark, tmp_path):
    cfg = config(tmp_path, "kept")
    base = cfg.folder("dim_customer")
    assert kept_watermark(spark, base) is None
    for n, (day, latest) in enumerate(zip(DAYS, [None, D(2020, 3, 1), D(2020, 4, 1)], strict=True), 1):
        write_sources(spark, cfg, f"address {n}", day, [str(n)])
        run_daily(spark, cfg, day + dt.timedelta(days=1))
        assert kept_watermark(spark, base) == latest
        assert read_table(spark, cfg.table("dim_customer")).agg(F.max("effective_to")).first()[0] == latest
    run_daily(spark, cfg, D(2020, 5, 1))
    assert kept_watermark(spark, base) == D(2020, 4, 1)


def test_contiguous_versions_give_one_row_for_each_order(spark):
    """A version closed late overlaps the next one; its validity ends where that begins."""
    versions = dim_customers(
        spark,
        [
            ("a1", "a", "x", D(2020, 1, 1), D(2020, 3, 9), False),
            ("a2", "a", "y", D(2020, 2, 1), D(2020, 2, 20), False),
            ("a3", "a", "z", D(2020, 4, 1), None, True),
        ],
    )
    days = [D(2019, 12, 31), D(2020, 1, 31), D(2020, 2, 1), D(2020, 3, 15), D(2020, 4, 1)]
    events = spark.createDataFrame([("a", d) for d in days], "customer_id string, day date")
    found = {}
    for contiguous in (False, True):
        joined = point_in_time_join(
            events, versions, "customer_id", "day", "customer_sk", spread=["day"], contiguous=contiguous
        )
        found[contiguous] = rows_of(joined, "day", "customer_sk")
    assert found[True] == list(zip(days, [None, "a1", "a2", "a2", "a3"], strict=True))
    assert len(found[False]) == 6 and (D(2020, 3, 15), None) in found[False]


def test_an_ambiguous_merge_fails_whatever_is_read(spark):
    target = spark.createDataFrame([("a", "1", None, True)], "sk string, v string, effective_to date, is_current boolean")
    twice = spark.createDataFrame([("a", "2", None, False)] * 2, target.schema)
    with pytest.raises(ValueError, match="several source rows match sk a"):
        merge_upsert(target, twice, "sk", F.col("is_current"), ["effective_to", "is_current"])
    closed = target.filter("v = '0'")
    with pytest.raises(ValueError, match="several source rows match sk a"):
        merge_upsert(closed, twice, "sk", F.col("is_current"), ["effective_to", "is_current"], frozen=target)


def test_names_and_places_are_quoted(spark, tmp_path):
    assert quoted("a.b`c") == "`a`.`b``c`"
    cfg = config(tmp_path / "it's a place", "quoted")
    write_sources(spark, cfg, "first", D(2020, 2, 1), ["1"])
    run_daily(spark, cfg, D(2020, 2, 2))
    assert spark.sql(f"SELECT count(*) FROM {quoted(cfg.table('fact_order_items'))}").first()[0] == 2
