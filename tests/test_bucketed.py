"""As-of joins of tables stored by key."""

import uuid

import pytest
from pyspark.sql import functions as F

from starmart.operators.lookup import KeySketches
from starmart.sources.bucketed import bucketed_point_in_time_join, write_bucketed
from starmart.sources.tables import create_namespace
from tests.helpers import plan_of, rows_of
from tests.test_skew import brute_force, events, versions  # noqa: F401  fixtures


@pytest.fixture
def stored(spark, conf, tmp_path, events, versions):  # noqa: F811
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="16")
    create_namespace(spark, "mart_bucketed", str(tmp_path / "ns"))
    names = [f"mart_bucketed.{kind}_{uuid.uuid4().hex}" for kind in ("events", "versions")]
    places = [str(tmp_path / name) for name in names]
    dealt = write_bucketed(events, names[0], places[0], "k", 16, KeySketches(events, ["k"], 16))
    kept = write_bucketed(versions, names[1], places[1], "k", 16)
    yield dealt, kept
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_rows_of_hot_and_missing_keys_lie_apart(spark, stored, events):  # noqa: F811
    dealt, kept = stored
    assert dealt.hot == ("0",) and kept.hot == ()
    found = rows_of(dealt.rows_apart(spark).select("k").distinct())
    assert found == sorted([("0",), (None,)], key=repr)
    assert dealt.rows(spark).count() + dealt.rows_apart(spark).count() == events.count()


def test_join(spark, stored, events, versions):  # noqa: F811
    joined = bucketed_point_in_time_join(spark, *stored, "day", "sk", spread=["event"])
    assert rows_of(joined, "event", "k", "day", "sk") == brute_force(events, versions)


def test_only_rows_kept_apart_move(spark, stored):
    """No exchange in the branch of the bucketed rows."""
    plan = plan_of(bucketed_point_in_time_join(spark, *stored, "day", "sk", spread=["event"]))
    bucketed = plan[plan.index("SortMergeJoin") : plan.index("BroadcastHashJoin")]
    assert "Exchange" not in bucketed and bucketed.count("Bucketed: true") == 2
    assert "Exchange hashpartitioning" not in plan


def test_tables_must_be_dealt_alike(spark, stored):
    from dataclasses import replace

    dealt, kept = stored
    with pytest.raises(ValueError, match="dealt differently"):
        bucketed_point_in_time_join(spark, dealt, replace(kept, buckets=8), "day", "sk", spread=["event"])


def test_keys_without_a_hot_one(spark, stored, events, versions, tmp_path):  # noqa: F811
    rows = events.filter(F.col("k") != "0")
    name = f"mart_bucketed.plain_{uuid.uuid4().hex}"
    dealt = write_bucketed(rows, name, str(tmp_path / "plain"), "k", 16)
    joined = bucketed_point_in_time_join(spark, dealt, stored[1], "day", "sk", spread=["event"])
    assert dealt.hot == () and rows_of(joined, "event", "k", "day", "sk") == brute_force(rows, versions)
    spark.sql(f"DROP TABLE {name}")
