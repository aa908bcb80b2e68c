"""Run log: step events folded into log rows, a per-run summary, latest runs.

Loaders report each step as an event ``(LoadDate, Procedure, Step, Status,
Message, RowsProcessed)``.  The original keeps a mutable log table and
updates it per call; here the events are an append-only dataset and the
log table is a fold over them, computed with windows and aggregates:

1. ``Run`` starts at 1 per ``(LoadDate, Procedure)``.  A ``Start`` without a
   row count whose step already started in the current run begins the next
   run (``bump``).  Bumps form a chain: from a run's first event, the next
   bump is the first such ``Start`` whose previous same-step start lies in
   the run.  That "next bump" pointer is a reverse running minimum; the
   chain from each group's first event is walked group by group; where a
   group has very many events, all running scans cut it into ordered parts
   (``scan.py``) and the chain is found by pointer doubling (O(log runs)
   joins) instead.
2. Each ``Start`` opens a row (``LogId`` = its sequence number).  Later
   ``Success`` / ``Failed`` events update the newest row: status and end
   time from the last one; message and row count from the last ``Failed``
   or the last non-NULL ``Success`` value.
3. A ``Start`` in the same run closes a row that is still ``Running``: it
   becomes ``Success`` with the start's time as end and the start's row
   count (so the count sent with a ``Start`` belongs to the previous step).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import like_any, seconds_crossed, time_of_day_text, ts_text
from tidemark.operators.scan import Parted, running, with_parts
from tidemark.operators.sizing import bounded_broadcast
from tidemark.functions.constants import (
    DELETE_PATTERNS,
    INSERT_PATTERNS,
    LATEST_RUNS,
    PREPARE_PATTERNS,
    STATUS_FAILED,
    STATUS_RUNNING,
    STATUS_START,
    STATUS_SUCCESS,
    STEP_DATES,
    UPDATE_PATTERNS,
    WAITING_SUFFIX,
)

GROUP = ("LoadDate", "Procedure")
RUN_KEY = ("LoadDate", "Procedure", "Run")
EVENT_COLUMNS = ("seq", "EventTime", "LoadDate", "Procedure", "Step", "Status", "Message", "RowsProcessed")
LOG_COLUMNS = (
    "LogId",
    "LoadDate",
    "Run",
    "Procedure",
    "Step",
    "Status",
    "StartDateTime",
    "EndDateTime",
    "Message",
    "RowsProcessed",
)


# --------------------------------------------------------------------------
# Summary and latest runs
# --------------------------------------------------------------------------


def log_summary(log: DataFrame) -> DataFrame:
    """One row per ``(LoadDate, Procedure, Run)`` with conditional aggregates."""
    rows = F.col("RowsProcessed")
    step = F.col("Step")
    s = log.groupBy(*RUN_KEY).agg(
        F.min("StartDateTime").alias("StartDateTime"),
        F.max("EndDateTime").alias("EndDateTime"),
        F.min("Status").alias("Status"),
        F.max(F.when(like_any(step, PREPARE_PATTERNS), rows).otherwise(F.lit(0))).alias("RowsProcessed"),
        F.sum(F.when(like_any(step, INSERT_PATTERNS), rows).otherwise(F.lit(0))).alias("RowsInserted"),
        F.sum(F.when(like_any(step, UPDATE_PATTERNS), rows).otherwise(F.lit(0))).alias("RowsUpdated"),
        F.sum(F.when(like_any(step, DELETE_PATTERNS), rows).otherwise(F.lit(0))).alias("RowsDeleted"),
        F.max(F.when(F.col("Status") == STATUS_RUNNING, step)).alias("InProgress"),
        F.max(F.when(step == STEP_DATES, F.col("Message")).otherwise(F.lit(""))).alias("Dates"),
        F.max(F.when(step == STEP_DATES, F.lit(0)).otherwise(rows)).alias("_work"),
    )
    waiting = (F.col("Run") > 1) & (F.col("_work") == 0)
    return s.select(
        F.concat(ts_text("LoadDate"), F.when(waiting, F.lit(WAITING_SUFFIX)).otherwise(F.lit(""))).alias(
            "Load"
        ),
        *RUN_KEY,
        "StartDateTime",
        "EndDateTime",
        time_of_day_text(seconds_crossed("StartDateTime", "EndDateTime")).alias("Elapsed"),
        "Status",
        "RowsProcessed",
        "RowsInserted",
        "RowsUpdated",
        "RowsDeleted",
        "InProgress",
        "Dates",
    )


def log_latest(log: DataFrame, n: int = LATEST_RUNS) -> DataFrame:
    """The newest ``n`` runs of the summary, newest first.

    The ``n`` candidate runs come from a narrow aggregate first; their keys
    (at most ``n``, broadcast under the checked limit) restrict the wide
    summary to them.  Ties on start time are broken by the run key.
    """
    order = [F.col("StartDateTime").desc(), *[F.col(c).asc() for c in RUN_KEY]]
    candidates = (
        log.groupBy(*RUN_KEY)
        .agg(F.min("StartDateTime").alias("StartDateTime"))
        .orderBy(*order)
        .limit(n)
        .select(*RUN_KEY)
    )
    runs = log.join(bounded_broadcast(candidates, n), list(RUN_KEY), "left_semi")
    return log_summary(runs).orderBy(*order).limit(n)


# --------------------------------------------------------------------------
# Fold of step events into log rows
# --------------------------------------------------------------------------


def _is(status: str) -> Column:
    return F.col("Status") == status


def _bumps_of_group(rows: pa.Table) -> pa.Table:
    """One group's candidates whose previous same-step start ``p`` lies in the run that they meet."""
    rows, found, begin = rows.sort_by("seq"), [], None
    for seq, p in zip(rows["seq"].to_pylist(), rows["p"].to_pylist()):
        bump = begin is None or p >= begin
        found.append(bump)
        begin = seq if bump else begin
    return rows.filter(pa.array(found, pa.bool_())).drop(["p"])


def run_bumps(events: Parted, hot_rows: int | None = None) -> DataFrame:
    """``(LoadDate, Procedure, seq)`` of the Start events that begin a new run.

    Without a hot group, each group's candidates (``hot_rows`` at most) are
    walked in one task, as the plain windows walk its rows; the rounds of
    pointer doubling, each some jobs whose plans the driver holds, are for
    groups that are cut into parts.
    """
    g = list(GROUP)
    starts = Parted(events.df.where(_is(STATUS_START)), events.group, events.split)
    prev = running(starts, [*g, "Step"], ["seq"], F.col("seq"), "max", "p", inclusive=False).df
    # an event that came twice does not repeat its own step
    cand = prev.where(F.col("RowsProcessed").isNull() & (F.col("p") < F.col("seq"))).select(*g, "seq", "p")
    if not events.split:
        return cand.groupBy(*g).applyInArrow(_bumps_of_group, cand.drop("p").schema).checkpoint()
    firsts = events.df.groupBy(*g).agg(F.min("seq").alias("node"))
    # next bump after node i = min{ j : p(j) >= i }: a reverse running minimum
    # over values keyed by p(j) and queries keyed by i (values first on ties).
    nothing = F.lit(None).cast("bigint")
    marks = (
        cand.select(*g, F.col("p").alias("key"), F.lit(1).alias("kind"), F.col("seq").alias("val"), nothing.alias("node"))
        .unionByName(cand.select(*g, F.col("seq").alias("key"), F.lit(0).alias("kind"), nothing.alias("val"), F.col("seq").alias("node")))
        .unionByName(firsts.select(*g, F.col("node").alias("key"), F.lit(0).alias("kind"), nothing.alias("val"), "node"))
    )
    parted = with_parts(marks, g, F.col("key"), hot_rows)
    jump = (
        running(parted, g, ["key", "kind"], F.col("val"), "min", "dst", reverse=True)
        .df.where((F.col("kind") == 0) & F.col("dst").isNotNull())
        .select(*g, F.col("node").alias("src"), "dst")
    )
    # Pointer doubling over one table of tagged rows: "J" rows map a node to
    # its 2^r-th successor, "R0" / "R" rows are the group's first node / the
    # chain nodes reached so far (distance < 2^r).  Each round is built from
    # the previous round's checkpoint, so the plan never grows, and costs
    # one checkpoint: R' = R + J(R), J' = J o J.
    null = F.lit(None).cast("bigint")
    state = jump.select(*g, F.lit("J").alias("t"), "src", "dst").unionByName(
        firsts.select(*g, F.lit("R0").alias("t"), F.col("node").alias("src"), null.alias("dst"))
    ).checkpoint()
    while True:
        jmp = state.where(F.col("t") == "J")
        got = state.where(F.col("t") != "J")
        r, j = got.alias("r"), jmp.alias("j")
        same = [F.col(f"r.{c}") == F.col(f"j.{c}") for c in g]
        hop = r.join(j, [*same, F.col("r.src") == F.col("j.src")]).select(
            *[F.col(f"r.{c}").alias(c) for c in g], F.lit("R").alias("t"), F.col("j.dst").alias("src"), null.alias("dst")
        )
        a, b = jmp.alias("a"), jmp.alias("b")
        same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in g]
        doubled = a.join(b, [*same, F.col("a.dst") == F.col("b.src")]).select(
            *[F.col(f"a.{c}").alias(c) for c in g], F.lit("J").alias("t"), F.col("a.src").alias("src"), F.col("b.dst").alias("dst")
        )
        state = got.unionByName(hop).unionByName(doubled).checkpoint()
        if state.where(F.col("t") == "J").isEmpty():
            break
    return state.where(F.col("t") == "R").select(*g, F.col("src").alias("seq"))


def log_fold(events: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Log rows (``LOG_COLUMNS``) from step events in arrival order ``seq``.

    The running scans (previous same-step start, run number, current row,
    next start) cut a group with more than ``hot_rows`` events into ordered
    parts (``scan.py``), so one busy procedure is not one task.
    """
    g = list(GROUP)
    parted = with_parts(events.select(*EVENT_COLUMNS), g, F.col("seq"), hot_rows)
    bumps = run_bumps(parted, hot_rows).withColumn("_bump", F.lit(1))
    ev = Parted(
        parted.df.join(bumps, [*g, "seq"], "left").withColumn("_bump", F.coalesce(F.col("_bump"), F.lit(0))),
        parted.group,
        parted.split,
    )
    ev = running(ev, g, ["seq"], F.col("_bump"), "sum", "_bumps")
    ev = running(ev, g, ["seq"], F.when(_is(STATUS_START), F.col("seq")), "max", "LogId")
    ev = ev.df.withColumn("Run", F.lit(1) + F.col("_bumps"))
    later = F.struct(
        F.col("seq").alias("s"), F.col("EventTime").alias("at"), F.col("RowsProcessed").alias("rows"), F.col("_bump").alias("bump")
    )
    starts = running(
        Parted(ev.where(_is(STATUS_START)), parted.group, parted.split),
        g, ["seq"], later, "min", "_next", reverse=True, inclusive=False,
    ).df.select(
        *g,
        "LogId",
        "Run",
        "Step",
        F.col("EventTime").alias("StartDateTime"),
        F.col("Message").alias("_start_message"),
        F.col("_next.at").alias("_next_at"),
        F.col("_next.rows").alias("_next_rows"),
        F.col("_next.bump").alias("_next_bump"),
    )
    done = _is(STATUS_SUCCESS) | _is(STATUS_FAILED)
    updates = (
        ev.where(done & F.col("LogId").isNotNull())
        .groupBy(*g, "LogId")
        .agg(
            F.max(F.struct("seq", "Status", "EventTime")).alias("_last"),
            F.max(
                F.when(_is(STATUS_FAILED) | F.col("Message").isNotNull(), F.struct("seq", "Message"))
            ).alias("_msg"),
            F.max(
                F.when(_is(STATUS_FAILED) | F.col("RowsProcessed").isNotNull(), F.struct("seq", "RowsProcessed"))
            ).alias("_rows"),
        )
    )
    r = starts.join(updates, [*g, "LogId"], "left")
    is_running = F.col("_last").isNull()
    closed = is_running & F.col("_next_at").isNotNull() & (F.col("_next_bump") == 0)
    return r.select(
        "LogId",
        "LoadDate",
        F.col("Run").cast("smallint").alias("Run"),
        "Procedure",
        "Step",
        F.when(~is_running, F.col("_last.Status"))
        .when(closed, F.lit(STATUS_SUCCESS))
        .otherwise(F.lit(STATUS_RUNNING))
        .alias("Status"),
        "StartDateTime",
        F.when(~is_running, F.col("_last.EventTime")).when(closed, F.col("_next_at")).alias("EndDateTime"),
        F.when(F.col("_msg").isNotNull(), F.col("_msg.Message")).otherwise(F.col("_start_message")).alias("Message"),
        F.when(F.col("_rows").isNotNull(), F.col("_rows.RowsProcessed"))
        .when(closed, F.col("_next_rows"))
        .alias("RowsProcessed"),
    )


def fold_increment(folded: DataFrame, events: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """The log after new events, from the folded rows so far and those events alone.

    ``events`` must be later than all folded ones. What a group's new events
    can still touch is its open state: the steps of its last run (a repeat of
    one begins the next run) and its newest row. Both are in the folded rows
    and are put before the new events as events of their own; rows before the
    newest, and groups without new events, stay as they are. An event that
    comes before its group's first Start changes no row, now or later.
    """
    g = list(GROUP)
    touched = events.select(*g).distinct()
    same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in g]
    last = (
        folded.alias("r").join(touched.alias("t"), same("r", "t"), "left_semi")
        .groupBy(*g).agg(F.max("LogId").alias("_last"), F.max("Run").alias("_run"))
    ).checkpoint()
    known = folded.alias("r").join(last.alias("l"), same("r", "l"), "left").select("r.*", "_last", "_run")
    open_rows = known.where(F.col("Run") == F.col("_run"))
    # a step's count with its Start belongs to the row before, which is not folded anew
    starts = open_rows.select(
        F.col("LogId").alias("seq"), F.col("StartDateTime").alias("EventTime"), *g, "Step",
        F.lit(STATUS_START).alias("Status"), "Message", F.lit(0).cast("bigint").alias("RowsProcessed"),
    )
    updates = open_rows.where((F.col("LogId") == F.col("_last")) & (F.col("Status") != STATUS_RUNNING)).select(
        (F.col("LogId") + 1).alias("seq"), F.col("EndDateTime").alias("EventTime"), *g, F.lit(None).cast("string").alias("Step"),
        "Status", "Message", "RowsProcessed",
    )
    fold = log_fold(starts.unionByName(updates).unionByName(events.select(*EVENT_COLUMNS)), hot_rows)
    new = fold.alias("r").join(last.alias("l"), same("r", "l"), "left").where(
        F.col("_last").isNull() | (F.col("LogId") >= F.col("_last"))
    )
    run = F.col("r.Run") + F.coalesce(F.col("_run"), F.lit(1)) - 1
    new = new.select(*[run.cast("smallint").alias("Run") if c == "Run" else F.col(f"r.{c}") for c in LOG_COLUMNS])
    kept = known.where(F.col("_last").isNull() | (F.col("LogId") < F.col("_last"))).select(*LOG_COLUMNS)
    return kept.unionByName(new)
