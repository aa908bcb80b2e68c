"""The landing stream appends new change files and raises the watermark."""

import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.streaming.watermark import current_watermark, land_with_watermark


def test_landing_stream_advances_watermark(spark, scratch):
    src = fx.tag_source(spark, SF_SMALL)
    landing = os.path.join(scratch, "landing")
    table = os.path.join(scratch, "silver", "Sales", "Orders")
    wm = os.path.join(scratch, "silver", "Sales_Tag", "__high_watermark")
    ckpt = os.path.join(scratch, "stream_ckpt")
    cut = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    src.where(F.col("LakeTimestamp") <= cut).write.mode("append").parquet(landing)

    def run():
        q = land_with_watermark(spark, landing, src.schema, table, wm, ckpt)
        q.awaitTermination(300)
        assert q.exception() is None

    run()
    first = src.where(F.col("LakeTimestamp") <= cut)
    assert spark.read.parquet(table).count() == first.count()
    assert current_watermark(spark, wm) == first.agg(F.max("LakeTimestamp")).first()[0]
    # new files: only they are landed, and the watermark moves up
    src.where(F.col("LakeTimestamp") > cut).write.mode("append").parquet(landing)
    run()
    assert spark.read.parquet(table).count() == src.count()
    assert current_watermark(spark, wm) == src.agg(F.max("LakeTimestamp")).first()[0]


def test_landing_feeds_the_driver(spark, scratch):
    from helpers import d, rows

    from tidemark.operators import tags
    from tidemark.plans import control
    from tidemark.plans.incremental import chain
    from tidemark.sources.warehouse import ParquetWarehouse
    from tidemark.spec import TableSpec

    src = fx.tag_source(spark, SF_SMALL)
    landing = os.path.join(scratch, "landing")
    root = os.path.join(scratch, "silver")
    table = os.path.join(root, "Sales", "Orders")
    cut = F.lit("1996-04-01 00:00:00").cast("timestamp_ntz")
    src.where(F.col("LakeTimestamp") <= cut).write.parquet(landing)
    q = land_with_watermark(
        spark, landing, src.schema, table, os.path.join(root, "Sales_Tag", "__high_watermark"),
        os.path.join(scratch, "ckpt"),
    )
    q.awaitTermination(300)
    schema = tags.empty_target(spark, src, ("k",), "latest").schema
    wh = ParquetWarehouse(
        spark, root, {("Sales_Tag", "Orders_Latest"): (TableSpec("Orders_Latest", ("k",)), schema)},
        views={("Sales", "Orders"): lambda s: s.read.parquet(table)},
    )
    control.run_control("latest", wh, date_limit=d("2030-01-01"), now=d("2024-01-01"))
    landed_max = src.where(F.col("LakeTimestamp") <= cut).agg(F.max("LakeTimestamp")).first()[0]
    expected = chain("latest", src, tags.empty_target(spark, src, ("k",), "latest"), ("k",), [landed_max], [d("2024-01-01")])[-1].state
    assert rows(wh.target("Sales_Tag", "Orders_Latest")) == rows(expected)
