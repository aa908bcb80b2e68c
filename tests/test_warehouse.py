"""End to end on parquet: drivers write keyed tag tables bucket by bucket."""

import os

from conftest import SF_SMALL
from helpers import d, rows

from tidemark import fixtures as fx
from tidemark.operators import runlog, tags
from tidemark.plans import control
from tidemark.plans.incremental import chain
from tidemark.sources.warehouse import ParquetWarehouse
from tidemark.spec import TableSpec

KINDS = ("first", "latest", "history")
LIMITS = (d("1996-01-01"), d("1996-04-01"), d("2003-01-01"))
NOWS = (d("2024-01-01"), d("2024-01-02"), d("2024-01-03"))


def bucket_files(path):
    return {b: sorted(os.listdir(os.path.join(path, b))) for b in os.listdir(path) if b.startswith("_bucket=")}


def test_drivers_on_parquet_match_the_pure_chain(spark, scratch):
    feed_path = os.path.join(scratch, "landing", "orders_feed")
    fx.tag_source(spark, SF_SMALL).write.parquet(feed_path)
    feed = spark.read.parquet(feed_path)
    specs = {}
    for kind in KINDS:
        name = f"Orders_{kind.capitalize()}"
        specs[("Sales_Tag", name)] = (TableSpec(name, ("k",)), tags.empty_target(spark, feed, ("k",), kind).schema)
    wh = ParquetWarehouse(
        spark, os.path.join(scratch, "silver"), specs,
        views={("Sales", "Orders"): lambda s: s.read.parquet(feed_path)}, buckets=64,
    )
    wh.set_watermark("Sales_Tag", d("2003-01-01"))
    latest_path = os.path.join(scratch, "silver", "Sales_Tag", "Orders_Latest")
    for n, (limit, now) in enumerate(zip(LIMITS, NOWS)):
        before = bucket_files(latest_path) if n == 1 else None
        for kind in KINDS:
            report = control.run_control(kind, wh, date_limit=limit, now=now)
            assert report.failure_message is None
        if n == 1:
            after = bucket_files(latest_path)
            untouched = [b for b in before if after.get(b) == before[b]]
            rewritten = [b for b in before if after.get(b) != before[b]]
            # the small second batch rewrites some buckets and leaves the rest alone
            assert untouched and rewritten
    for kind in KINDS:
        empty = tags.empty_target(spark, feed, ("k",), kind)
        expected = chain(kind, feed, empty, ("k",), LIMITS, NOWS)[-1].state
        got = wh.target("Sales_Tag", f"Orders_{kind.capitalize()}")
        assert rows(got) == rows(expected)
    # a finished window re-run changes nothing
    again = control.run_control("latest", wh, date_limit=LIMITS[-1], now=d("2024-02-01"))
    assert again.rows[0].date_from == again.rows[0].date_to
    # the step events fold into log rows: one run per target and load date,
    # except the re-run of Latest at the same load date, which is run 2
    log = runlog.log_fold(wh.log_events())
    assert log.where("Status = 'Failed'").count() == 0
    runs = {(r[0], r[1]) for r in log.groupBy("Procedure").agg({"Run": "max"}).collect()}
    assert runs == {("Sales_Tag.Orders_First", 1), ("Sales_Tag.Orders_Latest", 2), ("Sales_Tag.Orders_History", 1)}
    summary = runlog.log_summary(log).collect()
    assert {r["Procedure"] for r in summary} == {f"Sales_Tag.Orders_{k.capitalize()}" for k in KINDS}


def test_a_commit_that_stopped_half_way_is_repeated(spark, scratch):
    import pytest
    from helpers import TAG_SCHEMA

    from tidemark.sources.tables import KeyedParquetTable

    feed = [(k, d("2020-01-01"), d("2021-01-01") if k % 2 else d("2021-02-01"), "I") for k in range(40)]
    spark.createDataFrame(feed, TAG_SCHEMA).write.parquet(f"{scratch}/feed")
    source = spark.read.parquet(f"{scratch}/feed")
    for kind in KINDS:
        name = f"T_{kind.capitalize()}"
        schema = tags.empty_target(spark, source, ("k",), kind).schema
        wh = ParquetWarehouse(
            spark, f"{scratch}/wh", {("S_Tag", name): (TableSpec(name, ("k",)), schema)},
            views={("S", "T"): lambda s: s.read.parquet(f"{scratch}/feed")}, buckets=4,
        )
        wh.set_watermark("S_Tag", d("2022-01-01"))
        whole = KeyedParquetTable.append
        # the newest change lands, the rest does not
        KeyedParquetTable.append = lambda t, rows: (whole(t, rows.where("k = 0")), 1 / 0)
        try:
            with pytest.raises(control.ControlFailed):
                control.run_control(kind, wh, now=d("2024-01-01"))
        finally:
            KeyedParquetTable.append = whole
        assert wh.target("S_Tag", name).count() == 1 and wh.progress("S_Tag", name) is None
        r = control.run_control(kind, wh, now=d("2024-01-02"))
        assert r.rows[0].date_from == d("1900-01-01")
        keys = sorted(x["k"] for x in wh.target("S_Tag", name).collect())
        assert keys == list(range(40))
        assert wh.progress("S_Tag", name) == d("2021-02-01")
        again = control.run_control(kind, wh, now=d("2024-01-03"))
        assert again.rows[0].date_from == again.rows[0].date_to == d("2021-02-01")


def test_another_bucket_count_is_refused(spark, scratch):
    import pytest
    from pyspark.sql import types as T

    from tidemark.sources.tables import KeyedParquetTable

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    rows = spark.createDataFrame([(i, "a") for i in range(50)], schema)
    table = KeyedParquetTable(spark, f"{scratch}/t", ["k"], schema, buckets=4)
    table.upsert(rows, ["k"])
    KeyedParquetTable(spark, f"{scratch}/t", ["k"], schema, buckets=4).upsert(rows, ["k"])
    assert table.read().count() == 50
    with pytest.raises(ValueError, match="4 buckets"):
        KeyedParquetTable(spark, f"{scratch}/t", ["k"], schema, buckets=16).upsert(rows, ["k"])


def test_a_start_needs_a_step():
    import pytest

    from tidemark.plans.control import EventLog

    with pytest.raises(ValueError):
        EventLog().add(None, "p", None, "Start")
