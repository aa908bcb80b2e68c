"""History tables on parquet: open and closed versions apart, one commit per change."""

import os

import pytest
from helpers import HISTORY_SCHEMA, TAG_SCHEMA, d, rows

from tidemark.operators import tags
from tidemark.plans import control
from tidemark.plans.incremental import chain
from tidemark.sources import intervals
from tidemark.sources.tables import KeyedParquetTable
from tidemark.sources.versions import VersionedPartitions
from tidemark.sources.warehouse import ParquetWarehouse
from tidemark.spec import TableSpec

NAME = ("S_Tag", "T_History")


def batch(keys, capture, lake, code="U"):
    return [(k, d(capture), d(lake), code) for k in keys]


FIRST = batch(range(40), "2018-03-01", "2018-03-02", "I") + batch(range(40), "2019-05-01", "2019-05-02")
SECOND = batch(range(0, 40, 2), "2021-01-01", "2021-01-02")
LATE = batch([3], "2018-06-01", "2022-01-02")
LIMITS, NOWS = (d("2020-01-01"), d("2021-06-01"), d("2022-06-01")), (d("2024-01-01"), d("2024-01-02"), d("2024-01-03"))


def warehouse(spark, scratch):
    feed = spark.createDataFrame(FIRST + SECOND + LATE, TAG_SCHEMA)
    schema = tags.empty_target(spark, feed, ("k",), "history").schema
    wh = ParquetWarehouse(
        spark, f"{scratch}/wh", {NAME: (TableSpec(NAME[1], ("k",)), schema)},
        views={("S", "T"): lambda s: feed}, buckets=4, by_interval_end=True,
    )
    wh.set_watermark("S_Tag", d("2023-01-01"))
    return wh, feed


def load(wh, n):
    assert control.run_control("history", wh, date_limit=LIMITS[n], now=NOWS[n]).failure_message is None
    return set(wh._table(*NAME).parts.folders())


def years(folders):
    return {f.rsplit("=", 1)[1] for f in folders}


def test_in_order_batches_touch_open_versions_only(spark, scratch):
    wh, feed = warehouse(spark, scratch)
    one = load(wh, 0)
    assert years(one) == {"2019", "9999"}
    # what the next batch reads: no closed folder, by its files
    seen = wh.target_for(*NAME, spark.createDataFrame(SECOND, TAG_SCHEMA))
    assert seen.inputFiles() and all("/_until=9999/" in f for f in seen.inputFiles())
    two = load(wh, 1)
    assert years(one - two) == {"9999"}  # rewritten
    assert years(two - one) == {"2021", "9999"}  # added: the versions it closed, and the open ones
    # a late row reaches closed versions of its own bucket, from its capture on
    late = wh.target_for(*NAME, spark.createDataFrame(LATE, TAG_SCHEMA))
    assert {f.split("/_until=")[1][:4] for f in late.inputFiles()} >= {"2019", "9999"}
    assert len({f.split("_bucket=")[1].split("/")[0] for f in late.inputFiles()}) == 1
    pushed = late._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ExpiryTimestamp,2018-06-01" in pushed
    three = load(wh, 2)
    # all versions after the late capture are part of the change, in the one bucket of its key
    assert years(two - three) == {"2019", "9999"} and len(two - three) == 2
    empty = tags.empty_target(spark, feed, ("k",), "history")
    assert rows(wh.target(*NAME)) == rows(chain("history", feed, empty, ("k",), LIMITS, NOWS)[-1].state)


def test_a_change_shows_at_once_or_not_at_all(spark, scratch):
    wh, feed = warehouse(spark, scratch)
    load(wh, 0)
    before = rows(wh.target(*NAME))
    publish = VersionedPartitions._publish
    VersionedPartitions._publish = lambda self, folders: 1 / 0
    try:
        with pytest.raises(control.ControlFailed):
            control.run_control("history", wh, date_limit=LIMITS[1], now=NOWS[1])
    finally:
        VersionedPartitions._publish = publish
    assert rows(wh.target(*NAME)) == before  # all folders of the change are written, none is read
    load(wh, 1)
    load(wh, 2)
    empty = tags.empty_target(spark, feed, ("k",), "history")
    assert rows(wh.target(*NAME)) == rows(chain("history", feed, empty, ("k",), LIMITS, NOWS)[-1].state)


def test_many_small_folders_are_folded(spark, scratch, monkeypatch):
    monkeypatch.setattr(intervals, "MAX_FOLDERS", 2)
    schema = spark.createDataFrame([], HISTORY_SCHEMA).schema
    t = intervals.IntervalParquetTable(spark, f"{scratch}/t", ["k"], schema, "CaptureTimestamp", "ExpiryTimestamp", buckets=1)
    all_rows = []
    for i in range(5):
        r = (i, d("2020-01-01"), d(f"2020-02-0{i + 1}"), d("2020-01-01"), "I", d("2024-01-01"))
        all_rows.append(r)
        t.upsert(spark.createDataFrame([r], schema), ["k", "CaptureTimestamp"])
        assert len(t.places()[0, 2020]) <= 3
        assert rows(t.read()) == all_rows
    t.upsert(spark.createDataFrame([], schema), ["k", "CaptureTimestamp"])
    assert rows(t.read()) == all_rows


def test_another_layout_is_refused(spark, scratch):
    schema = spark.createDataFrame([], HISTORY_SCHEMA).schema
    r = spark.createDataFrame([(1, d("2020-01-01"), d("2021-01-01"), d("2020-01-01"), "I", d("2024-01-01"))], schema)
    KeyedParquetTable(spark, f"{scratch}/t", ["k"], schema, buckets=4).append(r)
    t = intervals.IntervalParquetTable(spark, f"{scratch}/t", ["k"], schema, "CaptureTimestamp", "ExpiryTimestamp", buckets=4)
    assert os.path.isdir(f"{scratch}/t")
    with pytest.raises(ValueError, match="interval ends"):
        t.upsert(r, ["k"])
