"""Inputs of the query catalog, derived by Spark from the test tables.

The warehouse procedures need change feeds, Live views, run logs and
partition lists; the test data is a TPC-H-like star schema.  Each function
below derives one such input from the given tables, so every catalog query
reads them and grows with them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: fixture parameters -------------------------------------------
# High watermarks of the three tag batches.
BATCH_WATERMARKS = (
    _dt.datetime(1996, 1, 1),
    _dt.datetime(1996, 4, 1),
    _dt.datetime(2003, 1, 1),
)
# The "now" written as UpdateTimestamp by each batch (never the clock).
BATCH_NOWS = (
    _dt.datetime(2024, 1, 1),
    _dt.datetime(2024, 1, 2),
    _dt.datetime(2024, 1, 3),
)
# Cut-offs of the two Live-view snapshots and the gold "now".
LIVE_CUTOFFS = (_dt.datetime(1996, 1, 1), _dt.datetime(1996, 7, 1))
# A third snapshot that holds every order.
LIVE_FULL = _dt.datetime(2003, 1, 1)
GOLD_NOW = _dt.datetime(2024, 1, 1)
TAG_KEYS = ("k",)
CUSTOMER_KEYS = ("c_custkey",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tag_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed keyed by customer: one change per order.

    Capture = order month; Lake = order date plus 0..399 days plus
    ``o_orderkey`` microseconds (unique); action from the order status.
    """
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("k"),
        F.trunc(F.col("o_orderdate").cast("date"), "MM").cast("timestamp_ntz").alias("CaptureTimestamp"),
        F.expr(
            "timestampadd(MICROSECOND, o_orderkey,"
            " timestampadd(DAY, cast((o_orderkey * 37) % 400 as int), o_orderdate))"
        ).alias("LakeTimestamp"),
        F.when(F.col("o_orderstatus") == "O", "I")
        .when(F.col("o_orderstatus") == "F", "D")
        .otherwise("U")
        .alias("LakeActionCode"),
    )


def live_customers(spark: SparkSession, sf_dir: str, cutoff: _dt.datetime) -> DataFrame:
    """A gold "Live" view: customer with nation, order count and value."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    o = table(spark, sf_dir, "orders").where(
        F.col("o_orderdate") <= F.lit(cutoff.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    )
    return (
        c.join(n, n.n_nationkey == c.c_nationkey)
        .join(o, o.o_custkey == c.c_custkey)
        .groupBy(c.c_custkey, c.c_name, c.c_mktsegment, n.n_name)
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            # summed exactly as decimal (order-independent), kept as double
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_price"),
            F.max("o_orderdate").alias("UpdateTimestamp"),
        )
    )


def _step_of_event() -> F.Column:
    return (
        F.when(F.col("event_type") == "click", "Dates")
        .when(F.col("event_type") == "view", "Insert")
        .when(F.col("event_type") == "purchase", "Update")
        .when(F.col("event_type") == "error", "Delete")
        .otherwise("X-Prepare")
    )


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run-log table (one row per step) derived from ``events``.

    LogId is the event id (increasing in arrival order, like an identity).
    """
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        eid.alias("LogId"),
        F.to_date("ts").cast("timestamp_ntz").alias("LoadDate"),
        (F.lit(1) + F.floor(F.hour("ts") / 12)).cast("smallint").alias("Run"),
        F.concat(F.lit("P"), (F.col("user_id") % 5).cast("string")).alias("Procedure"),
        _step_of_event().alias("Step"),
        F.when(eid % 97 == 0, "Failed").when(eid % 89 == 0, "Running").otherwise("Success").alias("Status"),
        F.col("ts").alias("StartDateTime"),
        F.when((eid % 89 == 0) & (eid % 97 != 0), F.lit(None))
        .otherwise(F.expr("timestampadd(SECOND, cast(event_id % 600 as int), ts)"))
        .alias("EndDateTime"),
        F.concat(F.lit("m"), eid.cast("string")).alias("Message"),
        F.when(eid % 11 == 0, F.lit(None).cast("bigint"))
        .when(F.col("user_id") % 5 == 0, F.lit(0).cast("bigint"))
        .otherwise(F.floor("value").cast("bigint"))
        .alias("RowsProcessed"),
    )


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Step events (calls of the logging step) derived from ``events``.

    Arrival order is the event id; groups are (day, procedure).  Starts
    without a row count re-open a run when their step repeats.
    """
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    status = F.when(eid % 13 == 0, "Failed").when(eid % 4 == 0, "Success").otherwise("Start")
    return e.select(
        eid.alias("seq"),
        F.col("ts").alias("EventTime"),
        F.to_date("ts").cast("timestamp_ntz").alias("LoadDate"),
        F.concat(F.lit("P"), (F.col("user_id") % 3).cast("string")).alias("Procedure"),
        _step_of_event().alias("Step"),
        status.alias("Status"),
        F.when(eid % 6 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("m"), eid.cast("string")))
        .alias("Message"),
        F.when((eid % 5 == 0) | ((status == "Start") & (eid % 2 == 0)), F.lit(None).cast("bigint"))
        .otherwise(F.floor("value").cast("bigint"))
        .alias("RowsProcessed"),
    )


# --- fixed values: partition-plan parameters -------------------------------------
PLAN_BOUNDARY = _dt.datetime(2002, 3, 1)
PLAN_FIRST_BOUNDARY = _dt.datetime(1996, 1, 1)
# Limit of the merge: later partitions fold into the one before.
MERGE_BOUNDARY = _dt.datetime(1998, 1, 1)
TIER_SPLIT = _dt.datetime(1996, 1, 1)


def _ship_month() -> F.Column:
    return F.trunc(F.col("l_shipdate").cast("date"), "MM").cast("timestamp_ntz")


def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing monthly boundaries of a dataset: ship months, every July missing."""
    li = table(spark, sf_dir, "lineitem")
    return li.where(F.month("l_shipdate") != 7).select(_ship_month().alias("Value")).distinct()


def partitioned_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as three datasets (by return flag) partitioned by ship month."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        F.lit("tpch").alias("SchemaName"),
        F.concat(F.lit("lineitem_"), F.col("l_returnflag")).alias("ObjectName"),
        _ship_month().alias("PartitionValue"),
    )


def partition_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions of those datasets: number (by month) and current tier."""
    parts = partitioned_lineitem(spark, sf_dir).select("SchemaName", "ObjectName", "PartitionValue").distinct()
    n = F.row_number().over(Window.partitionBy("SchemaName", "ObjectName").orderBy("PartitionValue"))
    split = F.lit(TIER_SPLIT.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return parts.select(
        "SchemaName",
        "ObjectName",
        "PartitionValue",
        n.alias("PartitionNumber"),
        F.when(F.col("PartitionValue") < split, "PAGE").otherwise("ROW").alias("CurrentCompression"),
    )


def stored_lineitem(spark: SparkSession, sf_dir: str, root: str):
    """Those datasets written under ``root``: months before the split as zstd, the others as snappy; a file each."""
    from tidemark.sources.versions import VersionedPartitions

    rows = partitioned_lineitem(spark, sf_dir)
    cols = ["SchemaName", "ObjectName", "PartitionValue"]
    rows = rows.repartition(*cols)
    stored = VersionedPartitions(spark, f"{root}/lineitem", rows.schema, cols)
    split = F.lit(TIER_SPLIT.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    cold = F.col("PartitionValue") < split
    stored.commit([(rows.where(cold), "zstd"), (rows.where(~cold), "snappy")])
    return stored


# --- fixed values: warehouse layout of the driver fixtures -------------------------
# Every change of a segment can load, but for the first one's, which is capped.
SILVER_WATERMARK = _dt.datetime(2003, 1, 1)
CAPPED_WATERMARK = _dt.datetime(1996, 4, 1)
CONTROL_LIMITS = (_dt.datetime(1996, 1, 1), _dt.datetime(2003, 1, 1))
TAG_KINDS = ("first", "latest", "history")


def segments(spark: SparkSession, sf_dir: str) -> list[str]:
    """Market segments of the customers (a handful of values)."""
    rows = table(spark, sf_dir, "customer").select("c_mktsegment").distinct().collect()
    return sorted(r[0] for r in rows)


def schema_name(segment: str) -> str:
    return segment.capitalize()


def segment_feed(spark: SparkSession, sf_dir: str, segment: str) -> DataFrame:
    """The change feed of one segment's customers (a silver source table)."""
    cust = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == segment).select(F.col("c_custkey").alias("k"))
    return tag_source(spark, sf_dir).join(cust, "k", "left_semi")


def stored_by_segment(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` written under ``path``, a partition for each value of ``c_mktsegment``, which ``of_segment`` reads alone."""
    part = F.concat(F.lit("s-"), "c_mktsegment")  # never empty, never a number
    rows.withColumn("_part", part).hint("rebalance", "_part").write.partitionBy("_part").parquet(path)
    schema = T.StructType([*rows.schema.fields, T.StructField("_part", T.StringType())])
    return rows.sparkSession.read.schema(schema).parquet(path)


def of_segment(stored: DataFrame, segment: str) -> DataFrame:
    """The rows of one segment of what ``stored_by_segment`` wrote."""
    return stored.where((F.col("_part") == f"s-{segment}") & (F.col("c_mktsegment") == segment)).drop("_part")


def stored_feed(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The feeds of all segments, joined once: every pair reads its own partition."""
    seg_of = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment").distinct()
    return stored_by_segment(tag_source(spark, sf_dir).join(seg_of, "k"), f"{root}/feed")


def segment_watermark(n: int) -> _dt.datetime:
    """High watermark of the n-th segment's tag schema."""
    return CAPPED_WATERMARK if n == 0 else SILVER_WATERMARK


def silver_warehouse(spark: SparkSession, sf_dir: str, stored: DataFrame | None = None):
    """Per segment: table ``Seg.Orders`` and view ``Seg_Derived.Returns``
    (delete actions only), their First / Latest / History tag tables in
    ``Seg_Tag``, a source without a target (``Seg.Lines``) and a tag-named
    view that must not match (``Seg_Tag.Lines_Latest``).  The last segment's
    tag schema has no high watermark, so its pairs fail. The feeds come from
    ``stored`` (``stored_feed``) where it is given."""
    from tidemark.operators.tags import empty_target
    from tidemark.sources.warehouse import FrameWarehouse
    from tidemark.spec import TableSpec

    wh = FrameWarehouse(spark)
    segs = segments(spark, sf_dir)
    for n, seg in enumerate(segs):
        s = schema_name(seg)
        feed = segment_feed(spark, sf_dir, seg) if stored is None else of_segment(stored, seg).drop("c_mktsegment")
        wh.tables[(s, "Orders")] = feed
        wh.tables[(s, "Lines")] = feed
        wh.views[(s + "_Derived", "Returns")] = feed.where(F.col("LakeActionCode") == "D")
        wh.views[(s + "_Tag", "Lines_Latest")] = feed
        for obj in ("Orders", "Returns"):
            for kind in TAG_KINDS:
                name = f"{obj}_{kind.capitalize()}"
                wh.tables[(s + "_Tag", name)] = empty_target(spark, feed, TAG_KEYS, kind)
                wh.specs[(s + "_Tag", name)] = TableSpec(name, TAG_KEYS)
        if n < len(segs) - 1:
            wh.tables[(s + "_Tag", "__high_watermark")] = spark.createDataFrame(
                [(segment_watermark(n),)], "LakeTimestamp timestamp_ntz"
            )
    return wh


def stored_silver(spark: SparkSession, sf_dir: str, root: str):
    """The same sources and tag tables on parquet under ``root``.

    The feed is written once, partitioned by segment; each source is a view
    of its segment's partition.
    """
    from tidemark.operators.tags import empty_target
    from tidemark.sources.warehouse import ParquetWarehouse
    from tidemark.spec import TableSpec

    seg_of = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"))
    feed = tag_source(spark, sf_dir).join(seg_of, "k")
    feed.hint("rebalance", "seg").write.partitionBy("seg").parquet(f"{root}/feed")
    stored = spark.read.parquet(f"{root}/feed")
    specs, views = {}, {}
    segs = segments(spark, sf_dir)
    for seg in segs:
        s = schema_name(seg)
        orders = stored.where(F.col("seg") == seg).drop("seg")
        returns = orders.where(F.col("LakeActionCode") == "D")
        views[(s, "Orders")] = lambda _, v=orders: v
        views[(s + "_Derived", "Returns")] = lambda _, v=returns: v
        for obj in ("Orders", "Returns"):
            for kind in TAG_KINDS:
                name = f"{obj}_{kind.capitalize()}"
                tag = empty_target(spark, orders, TAG_KEYS, kind).schema
                specs[(s + "_Tag", name)] = (TableSpec(name, TAG_KEYS), tag)
    wh = ParquetWarehouse(spark, f"{root}/silver", specs, views, buckets=4)
    for n, seg in enumerate(segs[:-1]):
        wh.set_watermark(schema_name(seg) + "_Tag", segment_watermark(n))
    return wh


def live_segment_nation(live: DataFrame) -> DataFrame:
    """A Live view keyed (wrongly) by segment alone: one row per segment and nation."""
    return live.groupBy("c_mktsegment", "n_name").agg(
        F.sum("order_count").alias("order_count"), F.max("UpdateTimestamp").alias("UpdateTimestamp")
    )


def stored_live(spark: SparkSession, sf_dir: str, cutoff: _dt.datetime, root: str) -> DataFrame:
    """A snapshot of ``live_customers``, aggregated once: every pair reads its own partition."""
    return stored_by_segment(live_customers(spark, sf_dir, cutoff), f"{root}/live-{cutoff:%Y%m%d}")


def gold_warehouse(spark: SparkSession, sf_dir: str, cutoff: _dt.datetime, wh=None, stored: DataFrame | None = None):
    """Per segment ``Dimension.Customer_<Seg>`` fed by ``Live.Customer_<Seg>``;
    ``Other.Customer_<Seg>`` must not match; ``Fact.SegmentNation`` is fed by
    a Live view with duplicate keys, so it fails; ``Bridge.Unfed`` has no
    Live source.  Passing ``wh`` swaps in the Live views at a new cut-off;
    they read ``stored`` (``stored_live``) where it is given."""
    from tidemark.sources.warehouse import FrameWarehouse
    from tidemark.spec import TableSpec

    fresh = wh is None
    wh = wh or FrameWarehouse(spark)
    live = live_customers(spark, sf_dir, cutoff) if stored is None else stored.drop("_part")
    for seg in segments(spark, sf_dir):
        name = "Customer_" + schema_name(seg)
        view = live.where(F.col("c_mktsegment") == seg) if stored is None else of_segment(stored, seg)
        wh.views[("Live", name)] = view
        if fresh:
            wh.tables[("Dimension", name)] = spark.createDataFrame([], view.schema)
            wh.specs[("Dimension", name)] = TableSpec(name, CUSTOMER_KEYS)
            wh.tables[("Other", name)] = spark.createDataFrame([], view.schema)
    sn = live_segment_nation(live)
    wh.views[("Live", "SegmentNation")] = sn
    if fresh:
        wh.tables[("Fact", "SegmentNation")] = spark.createDataFrame([], sn.schema)
        wh.specs[("Fact", "SegmentNation")] = TableSpec("SegmentNation", ("c_mktsegment",))
        wh.tables[("Bridge", "Unfed")] = spark.createDataFrame([], sn.schema)
    return wh


def stored_gold(spark: SparkSession, sf_dir: str, cutoff: _dt.datetime, root: str, wh=None):
    """``gold_warehouse`` with its targets on parquet under ``root``."""
    from tidemark.sources.warehouse import ParquetWarehouse
    from tidemark.spec import TableSpec

    stored = stored_live(spark, sf_dir, cutoff, root)
    live = stored.drop("_part")
    sn = live_segment_nation(live)
    names = {seg: "Customer_" + schema_name(seg) for seg in segments(spark, sf_dir)}
    if wh is None:
        specs = {("Dimension", n): (TableSpec(n, CUSTOMER_KEYS), live.schema) for n in names.values()}
        specs[("Fact", "SegmentNation")] = (TableSpec("SegmentNation", ("c_mktsegment",)), sn.schema)
        wh = ParquetWarehouse(spark, f"{root}/gold", specs, buckets=4)
    for seg, name in names.items():
        view = of_segment(stored, seg)
        wh.views[("Live", name)] = lambda _, v=view: v
    wh.views[("Live", "SegmentNation")] = lambda _: sn
    return wh
