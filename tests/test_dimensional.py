"""Gold upsert: type-1 overwrite, computed columns, candidate keys, key checks."""

import pytest
from helpers import d, rows
from pyspark.sql import functions as F

from tidemark.operators import dimensional, merge
from tidemark.spec import KeyContractError, assert_no_null_keys, assert_unique_keys

SCHEMA = "id bigint, name string, amount int, UpdateTimestamp timestamp_ntz"


def test_upsert_overwrites_changed_rows_and_inserts_new(spark):
    target = spark.createDataFrame([(1, "a", 1, d("2020-01-01")), (2, "b", 2, d("2020-01-01"))], SCHEMA)
    live = spark.createDataFrame(
        [(1, "a", 1, d("2020-01-01")), (2, "B", 20, d("2020-02-01")), (3, "c", 3, d("2020-02-02"))], SCHEMA
    )
    ch = dimensional.upsert_changes(live, target, ("id",), d("2020-01-01"), d("2030-01-01"))
    assert rows(ch, "id", "Upsert") == [(2, "U"), (3, "I")]
    with_filter = dimensional.upsert_changes(
        live, target, ("id",), d("2020-01-01"), d("2030-01-01"), candidate_filter=True, probe_rows=3
    )
    assert rows(with_filter) == rows(ch)
    state = merge.apply_dimensional(target, ch.drop("Upsert"), ("id",))
    assert rows(state) == [(1, "a", 1, d("2020-01-01")), (2, "B", 20, d("2020-02-01")), (3, "c", 3, d("2020-02-02"))]


def test_computed_columns_are_rederived_not_copied(spark):
    target = spark.createDataFrame([], SCHEMA + ", doubled int")
    live = spark.createDataFrame([(1, "a", 4, d("2020-01-01"))], SCHEMA)
    ch = dimensional.upsert_changes(
        live, target, ("id",), d("1899-01-01"), d("2030-01-01"), computed={"doubled": "amount * 2"}
    )
    assert rows(ch, "id", "doubled") == [(1, 8)]


def test_key_checks(spark):
    df = spark.createDataFrame([(1, "a", 1, None), (1, "b", 2, None), (None, "c", 3, None)], SCHEMA)
    with pytest.raises(KeyContractError):
        assert_no_null_keys(df, ("id",), "live")
    with pytest.raises(KeyContractError):
        assert_unique_keys(df.where("id is not null"), ("id",), "live")


def test_driver_passes_computed_columns(spark):
    from tidemark.plans import control
    from tidemark.sources.warehouse import FrameWarehouse
    from tidemark.spec import TableSpec

    wh = FrameWarehouse(spark)
    wh.views[("Live", "D")] = spark.createDataFrame([(1, "a", 4, d("2020-01-01"))], SCHEMA)
    wh.tables[("Dimension", "D")] = spark.createDataFrame([], SCHEMA + ", doubled int")
    wh.specs[("Dimension", "D")] = TableSpec("D", ("id",), {"doubled": "amount * 2"})
    control.run_control("dimensional", wh, date_limit=d("2024-01-01"), now=d("2024-01-01"))
    assert rows(wh.tables[("Dimension", "D")], "id", "doubled") == [(1, 8)]


def test_candidates_lead_the_view_below_its_aggregate(spark):
    """The semi join on the candidate keys reaches the rows the Live view aggregates."""
    base = spark.createDataFrame([(i % 10, d(f"2021-01-{1 + i % 20:02d}"), i) for i in range(100)], "id int, at timestamp_ntz, v int")
    live = base.groupBy("id").agg(F.max("at").alias("UpdateTimestamp"), F.sum("v").alias("v"))
    target = spark.createDataFrame([], live.schema)
    low, high = d("2021-01-18"), d("2030-01-01")
    plain = dimensional.upsert_changes(live, target, ("id",), low, high)
    found = dimensional.upsert_candidates(live, ("id",), low, high).checkpoint()
    led = dimensional.led_by_candidates(live, found, ("id",), found.count())
    plan = led._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")  # the join lies below the aggregate
    changes = dimensional.upsert_changes(led.checkpoint(), target, ("id",), low, high)
    assert sorted(map(str, changes.collect())) == sorted(map(str, plain.collect())) != []
