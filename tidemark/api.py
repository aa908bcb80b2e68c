"""One call per warehouse procedure, for users moving from the stored procedures.

============================  =================================================
Procedure / view              Call
============================  =================================================
Tag.First / Latest / History  ``tag_first`` / ``tag_latest`` / ``tag_history``
Dimensional.Upsert            ``dimensional_upsert``
Control.First / Latest /      ``control_first`` / ``control_latest`` /
History / Dimensional         ``control_history`` / ``control_dimensional``
Log.Logging                   ``log_logging``
Log.Summary / Log.Latest      ``log_summary_view`` / ``log_latest_view``
Utility.Partitioning          ``partitioning`` (+ ``rewrite_tiers``)
Utility.RemoteQuery           ``remote_query``
============================  =================================================

``wh`` is a warehouse (``sources/warehouse.py``): it names the source and
target tables, the high watermarks and the run log.  Tables are given as
``(schema, object)``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import runlog
from tidemark.plans import control
from tidemark.plans import partitions as pp
from tidemark.plans.incremental import StepResult
from tidemark.sources.remote import remote_query  # noqa: F401 - re-exported

Name = tuple[str, str]


def _load(kind, wh, source: Name, target: Name, date_from, date_to, dry_run, now) -> StepResult:
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    limit = date_to or now
    log = control.EventLog()
    try:
        return control.load_pair(kind, wh, source, target, limit, now, dry_run, log, date_from=date_from)
    finally:
        log.flush(wh)


def tag_first(wh, source: Name, target: Name, date_from=None, date_to=None, dry_run=False, now=None) -> StepResult:
    """Insert the first version of every key the target does not hold yet."""
    return _load("first", wh, source, target, date_from, date_to, dry_run, now)


def tag_latest(wh, source: Name, target: Name, date_from=None, date_to=None, dry_run=False, now=None) -> StepResult:
    """Upsert the newest version per key; late rows are dropped."""
    return _load("latest", wh, source, target, date_from, date_to, dry_run, now)


def tag_history(wh, source: Name, target: Name, date_from=None, date_to=None, dry_run=False, now=None) -> StepResult:
    """Maintain validity intervals per key, repairing them for late rows."""
    return _load("history", wh, source, target, date_from, date_to, dry_run, now)


def dimensional_upsert(wh, source: Name, target: Name, date_from=None, date_to=None, dry_run=False, now=None) -> StepResult:
    """Type-1 upsert of a gold table from its Live view."""
    return _load("dimensional", wh, source, target, date_from, date_to, dry_run, now)


def control_first(wh, date_limit=None, dry_run=False, **kw) -> control.ControlReport:
    return control.run_control("first", wh, date_limit=date_limit, dry_run=dry_run, **kw)


def control_latest(wh, date_limit=None, dry_run=False, **kw) -> control.ControlReport:
    return control.run_control("latest", wh, date_limit=date_limit, dry_run=dry_run, **kw)


def control_history(wh, date_limit=None, dry_run=False, **kw) -> control.ControlReport:
    return control.run_control("history", wh, date_limit=date_limit, dry_run=dry_run, **kw)


def control_dimensional(wh, date_limit=None, dry_run=False, **kw) -> control.ControlReport:
    return control.run_control("dimensional", wh, date_limit=date_limit, dry_run=dry_run, **kw)


def log_logging(wh, load_date, procedure, step=None, status="Start", message=None, rows_processed=None) -> None:
    """Record one step event in the warehouse's run log."""
    log = control.EventLog()
    log.add(load_date, procedure, step, status, message, rows_processed)
    wh.log(log.events)


def log_rows(wh) -> DataFrame:
    """The log table: step events folded into rows with run numbers."""
    return runlog.log_fold(wh.log_events())


def log_summary_view(wh) -> DataFrame:
    return runlog.log_summary(log_rows(wh))


def log_latest_view(wh, n: int = 1000) -> DataFrame:
    return runlog.log_latest(log_rows(wh), n)


@dataclass
class PartitionPlan:
    bounds: pp.PlanBounds
    spine: DataFrame
    plan: DataFrame
    tiers: DataFrame | None


def partitioning(
    spark: SparkSession,
    values: DataFrame,
    partitions: DataFrame | None = None,
    boundary: _dt.datetime | None = None,
    grain: str | None = None,
    row_boundary: int | None = 4,
    first_boundary: _dt.datetime | None = None,
    gap_fill: bool = False,
    trim: bool = False,
    schema: str | None = None,
    table: str | None = None,
) -> PartitionPlan:
    """The dry-run output of the partition procedure: bounds, plan and tiers.

    ``values``: existing boundaries (``existing_boundaries``); ``partitions``:
    ``SchemaName, ObjectName, PartitionNumber, CurrentCompression``.  Apply
    tiers with ``plans.partitions.rewrite_tiers``.
    """
    bounds = pp.plan_bounds(values, boundary, grain, first_boundary)
    plan = pp.partition_plan(spark, values, bounds, gap_fill, trim)
    tiers = pp.partition_tiers(partitions, row_boundary, schema, table) if partitions is not None else None
    return PartitionPlan(bounds, pp.boundary_spine(spark, bounds), plan, tiers)
