"""Physical plans: pushdown into the scan, checked broadcasts, one History exchange."""

import contextlib
import io
import os

from conftest import SF_SMALL
from helpers import d

from tidemark import fixtures as fx
from tidemark.operators import sizing, tags


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def stored_feed(spark, scratch):
    path = os.path.join(scratch, "feed")
    fx.tag_source(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def test_window_filter_reaches_the_scan(spark, scratch):
    feed = stored_feed(spark, scratch)
    empty = tags.empty_target(spark, feed, ("k",), "latest")
    ch = tags.latest_changes(feed, empty, ("k",), d("1995-01-01"), d("1996-01-01"), d("2024-01-01"), probe_rows=10)
    text = plan_text(ch)
    assert "GreaterThan(LakeTimestamp" in text and "LessThanOrEqual(LakeTimestamp" in text
    assert "ReadSchema: struct<k:bigint,CaptureTimestamp:timestamp_ntz,LakeTimestamp:timestamp_ntz,LakeActionCode:string>" in text


def test_probe_broadcast_only_under_the_limit(spark, scratch):
    feed = stored_feed(spark, scratch)
    keys = feed.select("k")
    assert sizing.fits_broadcast(keys, 1000)
    assert not sizing.fits_broadcast(keys, None)
    spark.conf.set(sizing.LIMIT_CONF, "100")
    try:
        assert not sizing.fits_broadcast(keys, 1000)
    finally:
        spark.conf.unset(sizing.LIMIT_CONF)
    target = tags.empty_target(spark, feed, ("k",), "latest").unionByName(
        feed.selectExpr("k", "CaptureTimestamp", "LakeTimestamp", "LakeActionCode", "LakeTimestamp AS UpdateTimestamp")
    )
    ch = tags.latest_changes(feed, target, ("k",), d("1995-01-01"), d("1996-01-01"), d("2024-01-01"), probe_rows=10)
    assert "BroadcastHashJoin LeftSemi" in plan_text(ch)


def test_history_scans_reduced_versions_with_one_exchange(spark, scratch):
    # the (key, capture) reduction is checkpointed; without hot keys the
    # expiry is one window over one exchange on the key
    feed = stored_feed(spark, scratch)
    target = tags.empty_target(spark, feed, ("k",), "history")
    ch = tags.history_changes(feed, target, ("k",), d("1900-01-01"), d("2003-01-01"), d("2024-01-01"), probe_rows=10)
    tree = plan_text(ch).split("\n\n")[0]
    assert tree.count("Window (") == 1 and tree.count("Sort (") == 1 and tree.count("- Exchange (") == 1
    assert "Scan ExistingRDD" in tree


def test_hot_keys_are_spread_over_key_and_part(spark, scratch):
    feed = stored_feed(spark, scratch)
    target = tags.empty_target(spark, feed, ("k",), "history")
    ch = tags.history_changes(
        feed, target, ("k",), d("1900-01-01"), d("2003-01-01"), d("2024-01-01"), probe_rows=10, hot_rows=2
    )
    text = plan_text(ch)
    assert "hashpartitioning(k#" in text and "_part#" in text


def test_bucket_upsert_reads_only_touched_buckets(spark, scratch):
    from pyspark.sql import functions as F

    from tidemark.sources.tables import BUCKET, KeyedParquetTable

    df = spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    t = KeyedParquetTable(spark, os.path.join(scratch, "t"), ["k"], df.schema, buckets=32)
    t.append(df)
    changes = spark.createDataFrame([(1, -1), (5000, -2)], "k bigint, v bigint")
    touched = t.touched_buckets(changes)
    assert 1 <= len(touched) <= 2
    stored = spark.read.parquet(t.path).where(F.col(BUCKET).isin(touched))
    import re

    filters = [line for line in plan_text(stored).splitlines() if line.startswith("PartitionFilters")]
    assert filters and re.search(r"_bucket#\d+ IN \(", filters[0])
    t.upsert(changes, ["k"])
    got = {r["k"]: r["v"] for r in t.read().collect()}
    assert len(got) == 2001 and got[1] == -1 and got[5000] == -2 and got[2] == 4


def test_warehouse_probe_reads_only_the_changed_keys_buckets(spark, scratch):
    import re

    from pyspark.sql import functions as F

    from tidemark.sources.warehouse import ParquetWarehouse
    from tidemark.spec import TableSpec

    df = spark.range(0, 1000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    wh = ParquetWarehouse(spark, scratch, {("S", "T"): (TableSpec("T", ("k",)), df.schema)}, buckets=64)
    wh._table("S", "T").append(df)
    probe = wh.target_for("S", "T", spark.createDataFrame([(3,), (7,)], "k bigint"))
    filters = [line for line in plan_text(probe).splitlines() if line.startswith("PartitionFilters")]
    assert filters and re.search(r"_bucket#\d+ IN \(", filters[0])
    assert {r["k"] for r in probe.where("k in (3, 7)").collect()} == {3, 7}
    assert probe.count() < 1000
