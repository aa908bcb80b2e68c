"""The query catalog: one Spark query per operator, run on the test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Loaders are
run as chains of incremental steps over in-memory states (no writes), so a
query shows the target a sequence of batches leaves behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.functions.columns import ts_text
from tidemark.functions.constants import EXPIRY
from tidemark.operators import dimensional, runlog, tags
from tidemark.plans import control
from tidemark.plans import partitions as pp
from tidemark.plans.pairs import discover_gold_pairs, discover_silver_pairs
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import remote
from tidemark.plans.incremental import chain, step

Query = Callable[[SparkSession, str], DataFrame]
# Independent pairs of a driver run are loaded concurrently.
PAIR_THREADS = 8


def _tag_chain(spark: SparkSession, sf_dir: str, kind: str, batches: int):
    src = fx.tag_source(spark, sf_dir)
    empty = tags.empty_target(spark, src, fx.TAG_KEYS, kind)
    return chain(
        kind, src, empty, fx.TAG_KEYS, fx.BATCH_WATERMARKS[:batches], fx.BATCH_NOWS[:batches]
    )


def _show_expiry(df: DataFrame) -> DataFrame:
    """9999-12-31 does not fit a pandas timestamp: render expiry as text."""
    if EXPIRY in df.columns:
        return df.withColumn(EXPIRY, ts_text(F.col(EXPIRY)))
    return df


def tag_state(kind: str, batches: int) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _show_expiry(_tag_chain(spark, sf_dir, kind, batches)[-1].state)

    q.__name__ = f"tag_{kind}_state_{batches}"
    return q


def tag_full(kind: str) -> Query:
    """An initial load of every change."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = fx.tag_source(spark, sf_dir)
        empty = tags.empty_target(spark, src, fx.TAG_KEYS, kind)
        loaded = chain(kind, src, empty, fx.TAG_KEYS, fx.BATCH_WATERMARKS[-1:], fx.BATCH_NOWS[:1])
        return _show_expiry(loaded[-1].state)

    q.__name__ = f"tag_{kind}_full"
    return q


def tag_changes(kind: str, batch: int) -> Query:
    """The change set (with its Upsert flag) of batch ``batch`` (1-based)."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        r = _tag_chain(spark, sf_dir, kind, batch)[-1]
        return _show_expiry(r.changes)

    q.__name__ = f"tag_{kind}_changes_{batch}"
    return q


def _gold_chain(spark: SparkSession, sf_dir: str, batches: int):
    """Gold upsert of the customer dimension from two Live snapshots."""
    out = []
    target = None
    for cutoff in fx.LIVE_CUTOFFS[:batches]:
        live = fx.live_customers(spark, sf_dir, cutoff)
        if target is None:
            target = spark.createDataFrame([], live.schema)
        r = step("dimensional", live, target, fx.CUSTOMER_KEYS, fx.GOLD_NOW, fx.GOLD_NOW)
        out.append((live, r))
        target = r.state
    return out


def dim_state(batches: int) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _gold_chain(spark, sf_dir, batches)[-1][1].state

    return q


def dim_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_chain(spark, sf_dir, 2)[-1][1].changes


def dim_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    live, r = _gold_chain(spark, sf_dir, 2)[-1]
    w = r.window
    return dimensional.upsert_candidates(live, fx.CUSTOMER_KEYS, w.date_from, w.date_to)


def dim_changes_by_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second snapshot's change set, led by its candidate keys."""
    live, r = _gold_chain(spark, sf_dir, 2)[-1]
    w = r.window
    found = dimensional.upsert_candidates(live, fx.CUSTOMER_KEYS, w.date_from, w.date_to).checkpoint()
    led = dimensional.led_by_candidates(live, found, fx.CUSTOMER_KEYS, found.count()).checkpoint()
    before = _gold_chain(spark, sf_dir, 1)[-1][1].state
    return dimensional.upsert_changes(led, before, fx.CUSTOMER_KEYS, w.date_from, w.date_to, probe_rows=w.rows)


def window_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of every batch of every loader: from, to, watermark, gate."""
    rows = []
    for kind in ("first", "latest", "history"):
        for i, r in enumerate(_tag_chain(spark, sf_dir, kind, 3), start=1):
            w = r.window
            rows.append((kind, i, w.date_from, w.date_to, w.watermark, w.is_open, w.message))
    for i, (_, r) in enumerate(_gold_chain(spark, sf_dir, 2), start=1):
        w = r.window
        rows.append(("dimensional", i, w.date_from, w.date_to, w.watermark, w.is_open, w.message))
    schema = (
        "target string, batch int, DateFrom timestamp_ntz, DateTo timestamp_ntz,"
        " Watermark timestamp_ntz, Processed boolean, Message string"
    )
    return spark.createDataFrame(rows, schema)


def log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.log_summary(fx.log_rows(spark, sf_dir))


def log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.log_latest(fx.log_rows(spark, sf_dir))


def log_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.log_fold(fx.log_events(spark, sf_dir))


def log_fold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log rows after three batches of events, each folded into the rows before."""
    events = fx.log_events(spark, sf_dir)
    low, high = events.agg(F.min("seq"), F.max("seq")).first()
    cuts = [low + (high - low) * k // 3 for k in (1, 2)]
    seq = F.col("seq")
    log = runlog.log_fold(events.where(seq <= cuts[0])).checkpoint()
    log = runlog.fold_increment(log, events.where((seq > cuts[0]) & (seq <= cuts[1]))).checkpoint()
    return runlog.fold_increment(log, events.where(seq > cuts[1]))


def partition_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pp.grain_stats(fx.boundaries(spark, sf_dir))


def _plan_bounds(spark: SparkSession, sf_dir: str, first=None):
    values = fx.boundaries(spark, sf_dir)
    return values, pp.plan_bounds(values, boundary=fx.PLAN_BOUNDARY, first_boundary=first)


def partition_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bounds = _plan_bounds(spark, sf_dir)
    return pp.boundary_spine(spark, bounds)


# (case, first boundary, gap fill, trim)
PLAN_CASES = (
    ("keep", None, False, False),
    ("trim", None, False, True),
    ("gapfill", None, True, False),
    ("gapfill_trim", None, True, True),
    ("first_trim", fx.PLAN_FIRST_BOUNDARY, False, True),
)


def partition_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the existing boundaries (one row per partition) are derived once
    values = fx.boundaries(spark, sf_dir).checkpoint()
    stats = pp.grain_stats(values).first()
    out = None
    for name, first, gap, trim in PLAN_CASES:
        bounds = pp.bounds_from_stats(stats, fx.PLAN_BOUNDARY, first_boundary=first)
        plan = pp.partition_plan(spark, values, bounds, gap_fill=gap, trim=trim).select(
            F.lit(name).alias("Case"), "*"
        )
        out = plan if out is None else out.unionByName(plan)
    return out


def partition_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pp.partition_tiers(fx.partition_list(spark, sf_dir))


def partition_tiers_focus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tier changes of one dataset."""
    return pp.partition_tiers(fx.partition_list(spark, sf_dir), schema="tpch", table="lineitem_R")


def partition_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the partitions that a trimming plan folds away, with their new partition."""
    data = fx.partitioned_lineitem(spark, sf_dir)
    values = pp.existing_boundaries(data, "PartitionValue").checkpoint()
    stats = pp.grain_stats(values).first()
    bounds = pp.bounds_from_stats(stats, fx.MERGE_BOUNDARY, first_boundary=fx.PLAN_FIRST_BOUNDARY)
    plan = pp.partition_plan(spark, values, bounds, trim=True)
    targets = pp.merge_targets(values, plan).withColumnRenamed("Value", "PartitionValue")
    moved = pp.merged_rows(data, targets.checkpoint(), "PartitionValue")
    return moved.select("l_orderkey", "l_linenumber", "ObjectName", "PartitionValue", "Neighbour")


def partition_recompress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a tier rewrite touches, with the tier they are rewritten into."""
    plist = fx.partition_list(spark, sf_dir)
    tiers = pp.partition_tiers(plist).join(
        plist.select("SchemaName", "ObjectName", "PartitionNumber", "PartitionValue"),
        ["SchemaName", "ObjectName", "PartitionNumber"],
    )
    rows = pp.tier_rows(
        fx.partitioned_lineitem(spark, sf_dir), tiers, ["SchemaName", "ObjectName", "PartitionValue"]
    )
    return rows.select("l_orderkey", "l_linenumber", "ObjectName", "PartitionNumber", "TargetCompression")


def _stored_lineitem(spark: SparkSession, sf_dir: str):
    return fx.stored_lineitem(spark, sf_dir, f"{ensure_checkpoint_dir(spark)}/datasets-{uuid.uuid4().hex}")


def partition_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitions of stored datasets, with their codec's tier, from file metadata."""
    listed = pp.partition_listing(_stored_lineitem(spark, sf_dir).files(), "PartitionValue")
    return listed.select("*", (F.col("Bytes") > 0).alias("HasBytes")).drop("Bytes", "Files")


def partition_tiers_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tier changes of stored datasets, from their listing."""
    return pp.partition_tiers(pp.partition_listing(_stored_lineitem(spark, sf_dir).files(), "PartitionValue"))


def partition_merge_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored datasets, read back after a trimming plan was applied."""
    data = _stored_lineitem(spark, sf_dir)
    listed = pp.partition_listing(data.files(), "PartitionValue")
    values = listed.select(F.col("PartitionValue").alias("Value")).distinct().checkpoint()
    bounds = pp.bounds_from_stats(pp.grain_stats(values).first(), fx.MERGE_BOUNDARY, first_boundary=fx.PLAN_FIRST_BOUNDARY)
    plan = pp.partition_plan(spark, values, bounds, trim=True)
    pp.apply_merge(data, pp.merge_targets(values, plan).withColumnRenamed("Value", "PartitionValue"), "PartitionValue")
    return data.read().select("l_orderkey", "l_linenumber", "ObjectName", "PartitionValue")


def partition_recompress_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stored partition's tier and rows after the tier changes were applied."""
    data, on = _stored_lineitem(spark, sf_dir), ["SchemaName", "ObjectName", "PartitionValue"]
    listed = pp.partition_listing(data.files(), "PartitionValue")
    tiers = pp.partition_tiers(listed).join(listed.select(*on, "PartitionNumber"), ["SchemaName", "ObjectName", "PartitionNumber"])
    pp.apply_tiers(data, tiers, on)
    now = pp.partition_listing(data.files(), "PartitionValue").select(*on, "PartitionNumber", "CurrentCompression")
    return now.join(data.read().groupBy(*on).agg(F.count(F.lit(1)).alias("n_rows")), on, "left")


def silver_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = fx.silver_warehouse(spark, sf_dir).registry()
    out = None
    for kind in fx.TAG_KINDS:
        p = discover_silver_pairs(registry, kind).select(F.lit(kind).alias("kind"), "*")
        out = p if out is None else out.unionByName(p)
    return out


def gold_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = fx.gold_warehouse(spark, sf_dir, fx.LIVE_CUTOFFS[0])
    return discover_gold_pairs(wh.registry())


def _scratch(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark)}/warehouse-{uuid.uuid4().hex}"


def _silver_report(spark: SparkSession, sf_dir: str, kind: str, feed: DataFrame | None = None) -> control.ControlReport:
    """Two driver runs (limits 1996-01-01, then 2003-01-01); the second's report."""
    feed = fx.stored_feed(spark, sf_dir, _scratch(spark)) if feed is None else feed
    wh = fx.silver_warehouse(spark, sf_dir, feed)
    report = None
    for limit, now in zip(fx.CONTROL_LIMITS, fx.BATCH_NOWS, strict=False):
        report = control.run_control(
            kind, wh, date_limit=limit, now=now, raise_on_failure=False, parallelism=PAIR_THREADS
        )
    return report


def _gold_report(spark: SparkSession, sf_dir: str) -> control.ControlReport:
    """Gold driver over the Live views at the first cut-off, then the second."""
    wh = None
    report = None
    root = _scratch(spark)
    for cutoff in fx.LIVE_CUTOFFS:
        wh = fx.gold_warehouse(spark, sf_dir, cutoff, wh, fx.stored_live(spark, sf_dir, cutoff, root))
        report = control.run_control(
            "dimensional", wh, date_limit=fx.GOLD_NOW, now=fx.GOLD_NOW, raise_on_failure=False,
            parallelism=PAIR_THREADS,
        )
    return report


def control_report(kind: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        if kind == "dimensional":
            return _gold_report(spark, sf_dir).to_df(spark)
        return _silver_report(spark, sf_dir, kind).to_df(spark)

    return q


def control_state(kind: str) -> Query:
    """What the driver's runs leave in the parquet targets, with each target's name.

    Silver: limits 1996-01-01, then 2003-01-01. Gold: three Live snapshots,
    the last with every order. A target whose pair fails stays empty.
    """

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _scratch(spark)
        options = {"raise_on_failure": False, "parallelism": PAIR_THREADS}
        if kind == "dimensional":
            wh = None
            for cutoff in (*fx.LIVE_CUTOFFS, fx.LIVE_FULL):
                wh = fx.stored_gold(spark, sf_dir, cutoff, root, wh)
                control.run_control(kind, wh, date_limit=fx.GOLD_NOW, now=fx.GOLD_NOW, **options)
            names = [n for n in wh.specs if n[0] == "Dimension"]
        else:
            wh = fx.stored_silver(spark, sf_dir, root)
            for limit, now in zip(fx.CONTROL_LIMITS, fx.BATCH_NOWS, strict=False):
                control.run_control(kind, wh, date_limit=limit, now=now, **options)
            names = [n for n in wh.specs if n[1].endswith("_" + kind.capitalize())]
        out = None
        for name in names:
            label = ".".join((control.LAYER[kind], *name))
            rows = wh.target(*name).select(F.lit(label).alias("Target"), "*")
            out = rows if out is None else out.unionByName(rows)
        return _show_expiry(out)

    q.__name__ = f"control_{kind}_state"
    return q


def control_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folded run log of parallel driver runs, without clock times.

    Two History runs over every segment (the pairs of one have no watermark
    and fail before their first step), and a gold run in which a Live view
    with duplicate keys fails.
    """
    root = _scratch(spark)
    options = {"raise_on_failure": False, "parallelism": PAIR_THREADS}
    silver = fx.stored_silver(spark, sf_dir, root)
    for limit, now in zip(fx.CONTROL_LIMITS, fx.BATCH_NOWS, strict=False):
        control.run_control("history", silver, date_limit=limit, now=now, **options)
    gold = fx.stored_gold(spark, sf_dir, fx.LIVE_CUTOFFS[0], root)
    control.run_control("dimensional", gold, date_limit=fx.GOLD_NOW, now=fx.GOLD_NOW, **options)
    events = silver.log_events().unionByName(gold.log_events())
    return runlog.log_fold(events).select("LoadDate", "Run", "Procedure", "Step", "Status", "Message", "RowsProcessed")


def failure_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx.stored_feed(spark, sf_dir, _scratch(spark))
    reports = [_silver_report(spark, sf_dir, k, feed) for k in fx.TAG_KINDS]
    reports.append(_gold_report(spark, sf_dir))
    return control.failure_frame(spark, reports)


REMOTE_QUERY_TEXT = (
    "SELECT o_orderstatus, count(*) AS n_orders, sum(o_totalprice) AS total_price, "
    "min(o_orderdate) AS first_order FROM {orders} GROUP BY o_orderstatus"
)


def remote_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query text as a source, run locally with the table bound to it."""
    return remote.remote_query(spark, REMOTE_QUERY_TEXT, orders=fx.table(spark, sf_dir, "orders"))


def _with_checkpoint_dir(q: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return q(spark, sf_dir)

    run.__name__ = getattr(q, "__name__", "query")
    return run


def queries() -> dict[str, Query]:
    return {name: _with_checkpoint_dir(q) for name, q in _queries().items()}


def _queries() -> dict[str, Query]:
    return {
        "remote_query": remote_query,
        "discover_silver_pairs": silver_pairs,
        "discover_gold_pairs": gold_pairs,
        "control_first_report": control_report("first"),
        "control_latest_report": control_report("latest"),
        "control_history_report": control_report("history"),
        "control_dimensional_report": control_report("dimensional"),
        "control_first_state": control_state("first"),
        "control_latest_state": control_state("latest"),
        "control_history_state": control_state("history"),
        "control_dimensional_state": control_state("dimensional"),
        "control_log_rows": control_log_rows,
        "failure_message": failure_message,
        "partition_grain": partition_grain,
        "partition_spine": partition_spine,
        "partition_plan": partition_plan,
        "partition_tiers": partition_tiers,
        "partition_tiers_focus": partition_tiers_focus,
        "partition_merge": partition_merge,
        "partition_recompress": partition_recompress,
        "partition_listing": partition_listing,
        "partition_tiers_stored": partition_tiers_stored,
        "partition_merge_stored": partition_merge_stored,
        "partition_recompress_stored": partition_recompress_stored,
        "log_summary": log_summary,
        "log_latest": log_latest,
        "log_fold": log_fold,
        "log_fold_incremental": log_fold_incremental,
        "dim_upsert_initial": dim_state(1),
        "dim_upsert_incremental": dim_state(2),
        "dim_changes": dim_changes,
        "dim_changes_by_candidates": dim_changes_by_candidates,
        "dim_candidates": dim_candidates,
        "window_bounds": window_bounds,
        "tag_first_full": tag_full("first"),
        "tag_latest_full": tag_full("latest"),
        "tag_history_full": tag_full("history"),
        "tag_first_initial": tag_state("first", 1),
        "tag_first_incremental": tag_state("first", 3),
        "tag_first_changes": tag_changes("first", 2),
        "tag_latest_initial": tag_state("latest", 1),
        "tag_latest_incremental": tag_state("latest", 3),
        "tag_latest_changes": tag_changes("latest", 2),
        "tag_history_initial": tag_state("history", 1),
        "tag_history_incremental": tag_state("history", 3),
        "tag_history_changes": tag_changes("history", 2),
    }
