"""Random batches against a plain Python model, and invariants of the results."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from starmart.config import Calendar
from starmart.functions.dates import date_key
from starmart.operators.merge import merge_upsert
from starmart.operators.scd2 import load_dimension, scd2_changes, scd2_expired, scd2_new, stage_dimension
from starmart.plans.dimensions import CUSTOMER, attach_date_key, calendar_dimension, empty_dimension
from starmart.sources.files import store
from tests.helpers import FLOOR, D, raw_customers, rows_of

START = D(2020, 1, 1)


def random_batch(rng, first_day, days):
    return [
        (f"c{rng.randrange(40)}", rng.choice("xyz"), first_day + dt.timedelta(days=rng.randrange(days)))
        for _ in range(rng.randrange(30, 90))
    ]


def model(state, batch, as_of):
    """One batch applied to [(sk, id, address, from, to, current)] by the written rules."""
    watermark = max([row[4] for row in state if row[4]], default=FLOOR)
    staged = {}
    for key, address, updated in sorted(batch, key=lambda r: (r[0], r[2], r[1])):
        if updated > watermark:
            staged.setdefault(key, (address, updated))
    current = {row[1]: row for row in state if row[5]}
    out = {row[0]: row for row in state}
    for key, (address, updated) in staged.items():
        old = current.get(key)
        if old and old[2] == address:
            continue
        sk = hashlib.sha256(f"{key}||{updated.isoformat()}".encode()).hexdigest()
        assert sk not in out
        out[sk] = (sk, key, address, updated, None, True)
        if old:
            out[old[0]] = (*old[:4], as_of - dt.timedelta(days=1), False)
    return list(out.values())


@pytest.mark.parametrize("seed", range(4))
def test_dimension_history(spark, seed):
    rng = random.Random(seed)
    state, dimension = [], empty_dimension(spark, CUSTOMER)
    for number in range(3):
        first_day = START + dt.timedelta(days=30 * number)
        batch, as_of = random_batch(rng, first_day, 30), first_day + dt.timedelta(days=30)
        raw = raw_customers(spark, batch)
        staged = stage_dimension(CUSTOMER, raw, F.lit(FLOOR))
        assert rows_of(scd2_changes(CUSTOMER, staged, dimension, as_of)) == rows_of(
            scd2_new(CUSTOMER, staged, dimension).unionByName(scd2_expired(CUSTOMER, staged, dimension, as_of))
        )
        dimension = store(load_dimension(CUSTOMER, raw, dimension, as_of, FLOOR, store), "dim_customer")
        state = model(state, batch, as_of)
        assert rows_of(dimension.drop("state", "zip_code_prefix")) == sorted(state, key=repr)
    current = dimension.filter("is_current").groupBy("customer_id").count()
    assert current.filter("count > 1").isEmpty()
    assert dimension.select("customer_sk").distinct().count() == dimension.count()


def test_left_and_full_outer_forms_agree(spark):
    """The full outer join of staged rows and current versions finds the same new and closed versions."""
    rng = random.Random(7)
    as_of = START + dt.timedelta(days=60)
    raw = [raw_customers(spark, random_batch(rng, START + dt.timedelta(days=30 * n), 30)) for n in range(2)]
    nothing, first_run = empty_dimension(spark, CUSTOMER), START + dt.timedelta(days=30)
    dimension = store(load_dimension(CUSTOMER, raw[0], nothing, first_run, FLOOR, store), "dim_customer")
    staged = stage_dimension(CUSTOMER, raw[1], F.lit(FLOOR))
    s, d = staged.alias("s"), dimension.alias("d")
    both = s.join(d, [F.col("s.customer_id") == F.col("d.customer_id"), F.col("d.is_current")], "fullouter")
    changed = F.col("d.address") != F.col("s.address")
    new = both.filter(F.col("d.address").isNull() | changed).select("s.customer_id", "s.updated_date")
    expired = both.filter(F.col("d.address").isNotNull() & changed).select("d.customer_sk")
    assert rows_of(scd2_new(CUSTOMER, staged, dimension), "customer_id", "effective_from") == rows_of(new)
    assert rows_of(scd2_expired(CUSTOMER, staged, dimension, as_of), "customer_sk") == rows_of(expired)


@pytest.mark.parametrize("seed", range(3))
def test_merge(spark, seed):
    rng = random.Random(seed)
    schema = "sk int, v int, flag boolean"
    target = [(k, rng.randrange(9), rng.random() < 0.5) for k in rng.sample(range(60), 30)]
    source = [(k, rng.randrange(9), rng.random() < 0.5) for k in rng.sample(range(60), 30)]
    found = {row[0]: row for row in source}
    want = [
        (k, v, found[k][2] if k in found and flag else flag) for k, v, flag in target
    ] + [row for row in source if row[0] not in {t[0] for t in target}]
    merged = merge_upsert(
        spark.createDataFrame(target, schema), spark.createDataFrame(source, schema), "sk", F.col("flag"), ["flag"]
    )
    assert rows_of(merged) == sorted(want, key=repr)


def test_computed_and_joined_date_keys_agree(spark):
    rng = random.Random(3)
    calendar = Calendar(D(2020, 1, 1), D(2025, 12, 31))
    days = [None if rng.random() < 0.1 else D(2019, 6, 1) + dt.timedelta(days=rng.randrange(3000)) for _ in range(800)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    keys = attach_date_key(df, calendar_dimension(spark, calendar), "day", "joined")
    assert keys.filter(~F.col("joined").eqNullSafe(date_key(F.col("day"), calendar))).isEmpty()
    assert keys.count() == len(days)
