"""Tables, contracts and whole runs over Parquet sources."""

import datetime as dt
import os
import subprocess
import sys
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart import Calendar, MartConfig, get_or_create_spark_session
from starmart.__main__ import JOBS, main
from starmart.plans.daily import run_daily
from starmart.sources.contracts import DIM_CUSTOMER, TABLES, enforce_contract
from starmart.sources.files import new_location, read_parquet, shared_dir, store, write_parquet
from starmart.sources.tables import (
    create_namespace,
    create_table,
    current_namespace,
    ensure_tables,
    live_snapshot,
    load_table,
    merge_into_table,
    read_table,
    switch_snapshot,
    table_names,
)
from tests.helpers import RAW_CUSTOMER, RAW_ITEM, RAW_ORDER, RAW_PRODUCT, D, dim_customers, rows_of

RAW_SELLER = RAW_CUSTOMER.replace("customer", "seller")


def config(tmp_path, name, **options):
    return MartConfig(
        inputs=str(tmp_path / "inputs"),
        staging=str(tmp_path / "staging"),
        warehouse=str(tmp_path / "warehouse"),
        namespace=f"mart_{name}",
        calendar=Calendar(D(2020, 1, 1), D(2020, 12, 31)),
        **options,
    )


def write_sources(spark, cfg, address, day, order_ids):
    created, price = D(2020, 1, 1), Decimal("5.00")
    frames = {
        "customers": ([("c1", address, "S", "Z", created, day)], RAW_CUSTOMER),
        "sellers": ([("s1", "a", "S", "Z", created, None)], RAW_SELLER),
        "products": ([("p1", "n", "cat", price, "L", 1.0, 2.0, 3.0, created, None)], RAW_PRODUCT),
        "orders": ([(o, "c1", day, day, None, None, day, "F") for o in order_ids], RAW_ORDER),
        "order_items": ([(o, i, "p1", "s1", price, price, day) for o in order_ids for i in "12"], RAW_ITEM),
    }
    for name, (rows, schema) in frames.items():
        write_parquet(spark.createDataFrame(rows, schema), cfg.inputs, name)


def test_two_daily_runs(spark, tmp_path):
    cfg = config(tmp_path, "daily")
    write_sources(spark, cfg, "first", D(2020, 2, 1), ["1", "2"])
    run_daily(spark, cfg, D(2020, 2, 2))
    assert {t.name for t in spark.catalog.listTables(cfg.namespace)} == set(TABLES)
    assert read_table(spark, cfg.table("dim_date")).count() == 367
    assert read_table(spark, cfg.table("fact_order_items")).count() == 4

    write_sources(spark, cfg, "second", D(2020, 3, 1), ["3"])
    run_daily(spark, cfg, D(2020, 3, 2))
    customers = read_table(spark, cfg.table("dim_customer"))
    assert rows_of(customers, "address", "effective_from", "effective_to", "is_current") == [
        ("first", D(2020, 2, 1), D(2020, 3, 1), False),
        ("second", D(2020, 3, 1), None, True),
    ]
    joined = spark.sql(
        f"""SELECT f.order_id, f.total_order_value, f.item_count, c.address, d.date
        FROM {cfg.table('fact_order_summary')} f
        JOIN {cfg.table('dim_customer')} c ON f.customer_sk = c.customer_sk
        JOIN {cfg.table('dim_date')} d ON f.order_date_key = d.date_key ORDER BY f.order_id"""
    )
    assert rows_of(joined) == [
        ("1", Decimal("10.00"), 2, "first", D(2020, 2, 1)),
        ("2", Decimal("10.00"), 2, "first", D(2020, 2, 1)),
        ("3", Decimal("10.00"), 2, "second", D(2020, 3, 1)),
    ]

    run_daily(spark, cfg, D(2020, 3, 3))
    assert rows_of(read_table(spark, cfg.table("dim_customer"))) == rows_of(customers)
    assert read_table(spark, cfg.table("fact_order_summary")).count() == 4


@pytest.mark.parametrize("strict", [True, False])
def test_broken_contracts_fail_a_strict_run(spark, tmp_path, strict):
    cfg = config(tmp_path, f"strict_{strict}".lower(), strict=strict)
    write_sources(spark, cfg, "first", D(2020, 2, 1), ["1"])
    stray = spark.createDataFrame([("9", "nobody", D(2020, 2, 1), None, None, None, None, "O")], RAW_ORDER)
    write_parquet(stray, cfg.inputs, "orders", "append")
    huge = [("1", str(n), "p1", "s1", Decimal("99999999.99"), Decimal("1.00"), None) for n in range(5, 7)]
    write_parquet(spark.createDataFrame(huge, RAW_ITEM), cfg.inputs, "order_items", "append")
    if strict:
        with pytest.raises(Exception, match="NULL in NOT NULL column|NUMERIC_VALUE_OUT_OF_RANGE"):
            run_daily(spark, cfg, D(2020, 2, 2))
        return
    run_daily(spark, cfg, D(2020, 2, 2))
    facts = read_table(spark, cfg.table("fact_order_summary"))
    assert rows_of(facts, "order_id", "total_order_value", "item_count") == [
        ("1", Decimal("200000009.98"), 4),
        ("9", None, None),
    ]


def test_ensure_tables_keeps_what_exists(spark, tmp_path):
    cfg = config(tmp_path, "ensure")
    ensure_tables(spark, cfg)
    load_table(dim_customers(spark, [("k", "a", "x", D(2020, 1, 1), None, True)]), cfg.table("dim_customer"), "append")
    ensure_tables(spark, cfg)
    assert read_table(spark, cfg.table("dim_customer")).count() == 1
    assert read_table(spark, cfg.table("fact_order_summary")).columns == TABLES["fact_order_summary"].names


DAY = "date_key int, date date, year int, month int, day int, day_of_week int, week_of_year int, quarter int, "
DAY += "day_of_year int, is_month_end boolean, is_month_start boolean, is_weekend boolean"


def one_day(spark, year):
    return spark.createDataFrame([(1, D(2020, 1, 1), year, *[1] * 6, True, True, True)], DAY)


def test_snapshot_may_read_its_own_table(spark, tmp_path):
    cfg = config(tmp_path, "snapshot")
    ensure_tables(spark, cfg)
    table = cfg.table("dim_date")
    switch_snapshot(one_day(spark, 1), table, cfg.folder("dim_date"))
    before = read_table(spark, table)
    switch_snapshot(before.withColumn("year", F.lit(2)), table, cfg.folder("dim_date"))
    assert rows_of(read_table(spark, table), "year") == [(2,)]
    assert rows_of(before, "year") == [(1,)]
    switch_snapshot(before.withColumn("year", F.lit(3)), table, cfg.folder("dim_date"))
    left = sorted(p.name for p in (tmp_path / "warehouse" / "dim_date").glob("snapshot-*"))
    assert left == ["snapshot-000002", "snapshot-000003"]


def test_unfinished_snapshots_are_never_attached(spark, tmp_path):
    cfg = config(tmp_path, "unfinished")
    ensure_tables(spark, cfg)
    base, table = cfg.folder("dim_date"), cfg.table("dim_date")
    switch_snapshot(one_day(spark, 1), table, base)
    (tmp_path / "warehouse" / "dim_date" / "snapshot-000002").mkdir()
    assert live_snapshot(spark, base).endswith("snapshot-000001")
    switch_snapshot(read_table(spark, table).withColumn("year", F.lit(2)), table, base)
    spark.sql(f"DROP TABLE {table}")
    ensure_tables(spark, cfg)
    assert live_snapshot(spark, base).endswith("snapshot-000003")
    assert rows_of(read_table(spark, table), "year") == [(2,)]


def test_failed_snapshot_leaves_the_table(spark, tmp_path):
    cfg = config(tmp_path, "failed")
    ensure_tables(spark, cfg)
    table = cfg.table("dim_date")
    switch_snapshot(one_day(spark, 1), table, cfg.folder("dim_date"))
    broken = read_table(spark, table).withColumn("year", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        switch_snapshot(broken, table, cfg.folder("dim_date"))
    assert rows_of(read_table(spark, table), "year") == [(1,)]


def test_append_goes_by_name_and_overwrite_replaces(spark, tmp_path):
    create_namespace(spark, "mart_modes")
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    create_table(spark, "mart_modes.t", df.schema, location=str(tmp_path / "t"))
    load_table(df, "mart_modes.t", "append")
    load_table(spark.createDataFrame([(2, "b")], "y int, x string"), "mart_modes.t", "append")
    assert rows_of(read_table(spark, "mart_modes.t")) == [("a", 1), ("b", 2)]
    load_table(spark.createDataFrame([(7.5,)], "z double"), "mart_modes.t", location=str(tmp_path / "t"))
    assert rows_of(read_table(spark, "mart_modes.t")) == [(7.5,)]


def test_merge_needs_a_catalog_with_row_level_operations(spark, tmp_path):
    cfg = config(tmp_path, "merge")
    ensure_tables(spark, cfg)
    source = dim_customers(spark, [("k", "a", "x", D(2020, 1, 1), None, True)])
    table = cfg.table("dim_customer")
    with pytest.raises(Exception, match="MERGE"):
        merge_into_table(source, table, "customer_sk", F.col(f"{table}.is_current"), ["effective_to", "is_current"])


def test_intermediate_results_live_in_the_shared_folder(spark):
    base = shared_dir(spark)
    assert base.startswith(spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    assert new_location(spark, "x") != new_location(spark, "x")
    df = store(spark.range(5).withColumn("d", F.lit(dt.date(2020, 1, 1))), "kept")
    assert all(base.removeprefix("file:") in file for file in df.inputFiles())
    assert df.count() == 5


class OtherSession:
    """A session of another master, with no shared folder set."""

    def __init__(self, master):
        self.folder = None
        self.conf = self.sparkContext = self
        self.master, self.applicationId = master, "app"

    def get(self, key, default=None):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_only_local_sessions_fall_back_to_a_temporary_folder():
    local = OtherSession("local[2]")
    assert shared_dir(local) == shared_dir(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(OtherSession("yarn"))


def test_jobs_run_one_by_one_from_the_command_line(spark, tmp_path):
    cfg = config(tmp_path, "jobs")
    write_sources(spark, cfg, "first", D(2020, 2, 1), ["1", "2"])
    places = ["--inputs", cfg.inputs, "--staging", cfg.staging, "--warehouse", cfg.warehouse]
    dates = ["--as-of", "2020-02-02", "--calendar-start", "2020-01-01", "--calendar-end", "2020-12-31"]
    for job in JOBS:
        if job != "daily":
            main([job, "--namespace", cfg.namespace, *places, *dates])
    assert table_names(spark, cfg.namespace) == sorted(TABLES)
    assert [read_table(spark, cfg.table(t)).count() for t in sorted(TABLES)] == [1, 367, 1, 1, 4, 2]
    assert current_namespace(spark) == "default"


def test_parquet_round_trip_and_modes(spark, tmp_path):
    df = spark.range(3)
    write_parquet(df, str(tmp_path), "n")
    write_parquet(df, str(tmp_path) + "/", "n", "append")
    assert read_parquet(spark, str(tmp_path), "n").count() == 6
    write_parquet(df, str(tmp_path), "n")
    assert read_parquet(spark, str(tmp_path), "n").count() == 3


def test_session_factory_takes_options(spark):
    session = get_or_create_spark_session("again", {"spark.sql.starmart.probe": "1"})
    assert session.conf.get("spark.sql.starmart.probe") == "1"
    assert session.conf.get("spark.sql.adaptive.enabled") == "true"


def test_every_job_may_have_a_process_and_a_catalog_of_its_own(spark, tmp_path):
    cfg = config(tmp_path, "processes")
    places = ["--inputs", cfg.inputs, "--staging", cfg.staging, "--warehouse", cfg.warehouse]
    places += ["--namespace", cfg.namespace, "--calendar-start", "2020-01-01", "--calendar-end", "2020-12-31"]
    options = "--master local[2] --conf spark.sql.shuffle.partitions=2 --conf spark.ui.enabled=false pyspark-shell"
    env = os.environ | {"PYTHONPATH": os.pathsep.join(sys.path), "PYSPARK_SUBMIT_ARGS": options}

    def run(job, as_of):
        command = [sys.executable, "-m", "starmart", job, "--as-of", as_of, *places]
        done = subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-3000:]

    write_sources(spark, cfg, "first", D(2020, 2, 1), ["1"])
    run("daily", "2020-02-02")
    write_sources(spark, cfg, "second", D(2020, 3, 1), ["2"])
    for job in JOBS:
        if job != "daily":
            run(job, "2020-03-02")

    ensure_tables(spark, cfg)
    assert rows_of(read_table(spark, cfg.table("dim_customer")), "address", "effective_to", "is_current") == [
        ("first", D(2020, 3, 1), False),
        ("second", None, True),
    ]
    facts = read_table(spark, cfg.table("fact_order_summary"))
    customers = read_table(spark, cfg.table("dim_customer"))
    assert rows_of(facts.join(customers, "customer_sk"), "order_id", "address") == [("1", "first"), ("2", "second")]
    assert read_table(spark, cfg.table("fact_order_items")).count() == 4
