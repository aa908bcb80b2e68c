"""Batch drivers: load every discovered pair with one common limit.

For each pair (in target order) a driver computes the change window,
capped by the common ``date_limit``, runs the loader and commits the next
state.  A failing pair is recorded in the report and the driver moves on;
after the loop all failures are reported together (and raised, unless
``raise_on_failure=False``).  Step events go to the warehouse's run log.

The pair list is catalog metadata (one row per table), so it is collected
to the driver; each pair's own work runs as Spark jobs.  Independent pairs
can run concurrently (``parallelism``) in threads that inherit the caller's
Spark properties.  The jobs of a pair carry a tag of their own
(``pair_tag``), by which ``cancel_pair`` stops that pair alone, and run in a
scheduler pool of their own: where the session schedules fairly
(``spark.scheduler.mode=FAIR``), a large pair does not hold up the small ones.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import itertools
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.constants import (
    FAILURE_HEADER,
    FAILURE_LINE,
    STATUS_FAILED,
    STATUS_START,
    STATUS_SUCCESS,
    INSERT_FLAG,
    STEP_CANDIDATES,
    STEP_CHANGES,
    STEP_CODE,
    STEP_COMBINE,
    STEP_DATES,
    STEP_EXISTING,
    STEP_FIRSTS,
    STEP_INSERT,
    STEP_UPDATE,
    UPDATE_FLAG,
    UPSERT,
)
from tidemark.functions.columns import in_window
from tidemark.operators.bounds import ChangeWindow, read_high_watermark
from tidemark.operators.dimensional import led_by_candidates, upsert_candidates
from tidemark.operators.tags import reduced_window
from tidemark.plans import pairs as pairing
from tidemark.plans.incremental import LOADERS, StepResult, loaded, window_of
from tidemark.spec import KeyContractError, assert_no_null_keys, assert_unique_keys, null_key_filter

PROCEDURES = {
    "first": "Control.First",
    "latest": "Control.Latest",
    "history": "Control.History",
    "dimensional": "Control.Dimensional",
}
LAYER = {"first": "silver", "latest": "silver", "history": "silver", "dimensional": "gold"}
# The first step each loader reports.
FIRST_STEP = {
    "first": STEP_FIRSTS,
    "latest": STEP_CHANGES,
    "history": STEP_CHANGES,
    "dimensional": STEP_CANDIDATES,
}
REPORT_SCHEMA = "i int, Target string, Message string, DateFrom timestamp_ntz, DateTo timestamp_ntz"


class ControlFailed(RuntimeError):
    def __init__(self, message: str, report: ControlReport) -> None:
        super().__init__(message)
        self.report = report


@dataclass
class ReportRow:
    i: int
    target: str
    message: str = ""
    date_from: _dt.datetime | None = None
    date_to: _dt.datetime | None = None


@dataclass
class ControlReport:
    procedure: str
    rows: list[ReportRow] = field(default_factory=list)

    @property
    def failure_message(self) -> str | None:
        failed = [r for r in self.rows if r.message != ""]
        if not failed:
            return None
        lines = "".join(FAILURE_LINE.format(target=r.target, message=r.message) for r in failed)
        return FAILURE_HEADER.format(me=self.procedure) + lines

    def to_df(self, spark: SparkSession) -> DataFrame:
        data = [(r.i, r.target, r.message, r.date_from, r.date_to) for r in self.rows]
        return spark.createDataFrame(data, REPORT_SCHEMA)


class EventLog:
    """Step events of one driver run, numbered in arrival order; shared by parallel pairs."""

    def __init__(self, start: int | None = None) -> None:
        self._seq = itertools.count(start if start is not None else time.time_ns() // 1000)
        self.events: list[tuple] = []
        self._written = 0
        self._adding = threading.Lock()
        self._flushing = threading.Lock()

    def add(self, load_date, procedure, step_name, status, message=None, rows=None, at=None) -> None:
        if status == STATUS_START and step_name is None:
            raise ValueError("a Start event needs a step")
        at = at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        with self._adding:
            self.events.append((next(self._seq), at, load_date, procedure, step_name, status, message, rows))

    def flush(self, wh) -> None:
        """Write the events since the last flush, so that a running load shows in the log.

        Events that other pairs add during the write are left to the next
        flush; after a failed write the same ones are written again.
        """
        with self._flushing:
            with self._adding:
                end = len(self.events)
            wh.log(self.events[self._written : end])
            self._written = end


def _observed(df: DataFrame, *metrics) -> tuple[DataFrame, dict]:
    """``df`` written to the checkpoint folder, and metrics taken on the way."""
    seen = Observation()
    done = df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).checkpoint()
    return done, seen.get


def _null_keys(keys) -> Column:
    return F.count(F.when(null_key_filter(keys), 1)).alias("null_keys")


def _refuse_null_keys(metrics: dict, keys, what: str) -> None:
    if metrics.get("null_keys"):
        raise KeyContractError(f"{what}: NULL in key columns {list(keys)}")


def _load_window(
    kind: str, wh, source, target, src: DataFrame, tgt: DataFrame, w: ChangeWindow, now, load_date, log: EventLog, validate: bool
) -> StepResult:
    """Change set and commit of an open window, with an event as each step begins.

    The source is read once, into a reduced frame in the checkpoint folder;
    key checks, touched buckets and the change set work on that. Row counts
    are observed while the frames are written, no job counts them.
    """
    me, spec, ts_col = ".".join(target), wh.spec(*target), LOADERS[kind].ts_col
    begin = lambda name, rows: log.add(load_date, me, name, STATUS_START, rows=rows)
    begin(FIRST_STEP[kind], 0)
    log.flush(wh)
    options: dict = {}
    if kind == "dimensional":
        options["computed"] = dict(spec.computed)
        found, seen = _observed(upsert_candidates(src, spec.keys, w.date_from, w.date_to))
        begin(STEP_CHANGES, seen.get("rows", 0))
        src, _ = _observed(led_by_candidates(src, found, spec.keys, seen.get("rows", 0)))
        led = src.where(in_window(ts_col, w.date_from, w.date_to))
    else:
        src, seen = _observed(reduced_window(kind, src, spec.keys, w.date_from, w.date_to), _null_keys(spec.keys))
        options["probe_rows"] = seen.get("rows", 0)
        led = src
        if validate:
            _refuse_null_keys(seen, spec.keys, ".".join(source))
    # read only the target buckets the window's keys hash to
    probed = wh.target_for(*target, led) if hasattr(wh, "target_for") else None
    stored = Observation()
    if kind == "history":
        options["existing"] = stored
    result = loaded(kind, src, tgt, spec.keys, w, now, probed, **options)
    if kind == "history":
        begin(STEP_EXISTING, w.rows)
        begin(STEP_COMBINE, stored.get.get("rows", 0))
    changes, total, counts, newest = result.changes, w.rows, {}, None
    if getattr(wh, "record_counts", True):
        of = lambda flag: F.count(F.when(F.col(UPSERT) == flag, 1))
        changes, seen = _observed(
            changes, of(INSERT_FLAG).alias("inserts"), of(UPDATE_FLAG).alias("updates"), F.max(ts_col).alias("newest"), _null_keys(spec.keys)
        )
        total, newest = seen.get("rows", 0), seen.get("newest")
        counts = {INSERT_FLAG: seen.get("inserts", 0), UPDATE_FLAG: seen.get("updates", 0)}
    if validate and kind == "dimensional":
        if counts:
            _refuse_null_keys(seen, spec.keys, ".".join(source))
        else:
            assert_no_null_keys(changes, spec.keys, ".".join(source))
        assert_unique_keys(changes, spec.keys, ".".join(source))
    begin(STEP_INSERT if kind == "first" else STEP_UPDATE, total)
    log.flush(wh)
    wh.commit(*target, kind, result.state, changes, total)
    if hasattr(wh, "progress"):
        wh.advance(*target, newest)
    if kind != "first":
        begin(STEP_INSERT, counts.get(UPDATE_FLAG, 0))
    log.add(load_date, me, None, STATUS_SUCCESS, rows=counts.get(INSERT_FLAG, 0))
    return StepResult(w, changes, result.state)


def load_pair(
    kind: str,
    wh,
    source: tuple[str, str],
    target: tuple[str, str],
    date_limit: _dt.datetime,
    now: _dt.datetime,
    dry_run: bool = False,
    log: EventLog | None = None,
    validate: bool = True,
    date_from: _dt.datetime | None = None,
) -> StepResult:
    """Load one target from one source; raises on failure (after logging it).

    ``date_from`` replays from an explicit low bound; by default it is the
    newest timestamp of the finished commits where the warehouse keeps it
    (none yet: everything is loaded again, which changes no finished row),
    else the newest the target holds.  ``date_limit`` caps the watermark.
    A dry run computes the window alone and writes nothing but its events.
    """
    log = log or EventLog()
    me = ".".join(target)
    load_date = None
    try:
        if kind == "dimensional":
            watermark = now
        else:
            watermark = read_high_watermark(wh.watermark(target[0]))
        load_date = min(watermark, date_limit)
        src, tgt = wh.source(*source), wh.target(*target)
        log.add(load_date, me, STEP_DATES, STATUS_START)
        log.flush(wh)
        if date_from is None and hasattr(wh, "progress"):
            date_from = wh.progress(*target) or LOADERS[kind].default_low
        w = window_of(kind, src, tgt, watermark, date_from, date_limit)
        log.add(load_date, me, None, STATUS_SUCCESS, w.message, 1 if w.is_open else 0)
        result = StepResult(w, None, tgt)
        if not w.is_open:
            return result
        log.add(load_date, me, STEP_CODE, STATUS_START, f"{LOADERS[kind].name} {w.message}")
        if not dry_run:
            result = _load_window(kind, wh, source, target, src, tgt, w, now, load_date, log, validate)
        log.add(load_date, me, None, STATUS_SUCCESS)
        return result
    except Exception as e:
        log.add(load_date, me, None, STATUS_FAILED, str(e))
        raise
    finally:
        log.flush(wh)


def discover(kind: str, registry: DataFrame) -> DataFrame:
    if kind == "dimensional":
        return pairing.discover_gold_pairs(registry)
    return pairing.discover_silver_pairs(registry, kind)


POOL = "spark.scheduler.pool"


def pair_tag(kind: str, target: tuple[str, str]) -> str:
    """The job tag of a target's load (a tag holds no comma)."""
    return f"{PROCEDURES[kind]}:{target[0]}.{target[1]}".replace(",", "_")


def cancel_pair(spark: SparkSession, kind: str, target: tuple[str, str]) -> None:
    """Stop the running jobs of one pair; the pair fails and is reported, the others go on."""
    spark.sparkContext.cancelJobsWithTag(pair_tag(kind, target))


@contextlib.contextmanager
def _jobs_of(spark: SparkSession, tag: str):
    """Jobs begun inside carry ``tag`` and run in the pool of that name."""
    sc = spark.sparkContext
    pool = sc.getLocalProperty(POOL)
    sc.addJobTag(tag)
    sc.setLocalProperty(POOL, tag)
    try:
        yield
    finally:
        sc.removeJobTag(tag)
        sc.setLocalProperty(POOL, pool)


def run_control(
    kind: str,
    wh,
    date_limit: _dt.datetime | None = None,
    now: _dt.datetime | None = None,
    dry_run: bool = False,
    raise_on_failure: bool = True,
    parallelism: int = 1,
    validate: bool = True,
    log: EventLog | None = None,
) -> ControlReport:
    """Run one loader kind over all discovered pairs; report every target."""
    utc_now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    date_limit = date_limit or utc_now
    now = now or utc_now
    log = log or EventLog()
    layer = LAYER[kind]
    pairs = discover(kind, wh.registry()).orderBy("i").collect()
    report = ControlReport(PROCEDURES[kind])

    def one(p) -> ReportRow:
        row = ReportRow(p["i"], f"{layer}.{p['target_schema']}.{p['target_object']}", "", None, date_limit)
        try:
            if p["n_sources"] > 1:
                raise ValueError(f"{p['n_sources']} sources map to this target")
            target = (p["target_schema"], p["target_object"])
            with _jobs_of(wh.spark, pair_tag(kind, target)):
                r = load_pair(
                    kind, wh, (p["source_schema"], p["source_object"]), target, date_limit, now, dry_run, log, validate
                )
            row.date_from, row.date_to = r.window.date_from, r.window.date_to
        except Exception as e:  # noqa: BLE001 - failures are isolated per target
            row.message = str(e)
        return row

    if parallelism > 1:
        with ThreadPoolExecutor(parallelism) as pool:
            # each pair gets a copy of the caller's properties of its own: its tag and pool are set in it
            started = [pool.submit(inheritable_thread_target(wh.spark)(one), p) for p in pairs]
            report.rows = [f.result() for f in started]
    else:
        report.rows = [one(p) for p in pairs]
    text = report.failure_message
    if text and raise_on_failure:
        raise ControlFailed(text, report)
    return report


def failure_messages(reports: DataFrame) -> DataFrame:
    """One failure text per procedure from report rows, as a Spark aggregate.

    ``reports``: ``Procedure`` plus the report columns.  The lines of the
    failed targets are concatenated in pair order (``listagg ... WITHIN GROUP
    (ORDER BY i)``) under the header; procedures without failures give no row.
    """
    header, line = FAILURE_HEADER.split("{me}"), FAILURE_LINE.split("{target}")
    line_msg = line[1].split("{message}")
    failed = reports.where(F.col("Message") != "").select(
        "Procedure",
        "i",
        F.concat(F.lit(line[0]), F.col("Target"), F.lit(line_msg[0]), F.col("Message"), F.lit(line_msg[1])).alias("_line"),
    )
    return failed.groupBy("Procedure").agg(
        F.concat(
            F.lit(header[0]), F.col("Procedure"), F.lit(header[1]),
            F.expr("listagg(_line, '') WITHIN GROUP (ORDER BY i)"),
        ).alias("Message")
    )


def failure_frame(spark: SparkSession, reports: list[ControlReport]) -> DataFrame:
    """``failure_messages`` over the reports of several driver runs."""
    frames = [r.to_df(spark).select(F.lit(r.procedure).alias("Procedure"), "*") for r in reports]
    allrows = frames[0]
    for f in frames[1:]:
        allrows = allrows.unionByName(f)
    return failure_messages(allrows)

