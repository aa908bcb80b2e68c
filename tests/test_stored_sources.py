"""Sources of the driver queries that are written once: the same rows, read without a shuffle."""

from pyspark.sql import functions as F

from tidemark import fixtures as fx

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(str, df.collect()))


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_live_views_of_a_snapshot_are_read_by_segment(spark, scratch):
    cutoff = fx.LIVE_CUTOFFS[1]
    wh = fx.stored_gold(spark, SF, cutoff, scratch)
    live = fx.live_customers(spark, SF, cutoff)
    for seg in fx.segments(spark, SF):
        view = wh.source("Live", "Customer_" + fx.schema_name(seg))
        assert _rows(view) == _rows(live.where(F.col("c_mktsegment") == seg))
        assert _shuffles(view) == 0
    assert _rows(wh.source("Live", "SegmentNation")) == _rows(fx.live_segment_nation(live))


def test_feeds_are_read_by_segment(spark, scratch):
    stored = fx.stored_feed(spark, SF, scratch)
    wh = fx.silver_warehouse(spark, SF, stored)
    for seg in fx.segments(spark, SF):
        feed = wh.source(fx.schema_name(seg), "Orders")
        assert _rows(feed) == _rows(fx.segment_feed(spark, SF, seg))
        assert _shuffles(feed) == 0


def test_odd_segments_keep_their_rows(spark, scratch):
    rows = spark.createDataFrame([("", 1), ("01", 2), ("1", 3), (None, 4), ("a/b", 5)], "c_mktsegment string, n int")
    stored = fx.stored_by_segment(rows, f"{scratch}/odd")
    for seg, n in (("", 1), ("01", 2), ("1", 3), ("a/b", 5)):
        assert [tuple(r) for r in fx.of_segment(stored, seg).collect()] == [(seg, n)]
    assert stored.count() == 5
    assert fx.stored_by_segment(rows.limit(0), f"{scratch}/none").count() == 0
