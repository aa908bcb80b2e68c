"""Run-log fold rules, summary and latest runs on hand-made events."""

import datetime as dt

from helpers import d

from tidemark.operators import runlog
from tidemark.sources.warehouse import EVENT_SCHEMA

LD = d("2024-01-01")


def events(spark, data):
    base = d("2024-01-02 10:00:00")
    out = []
    for seq, proc, step, status, msg, rows in data:
        out.append((seq, base + dt.timedelta(seconds=seq), LD, proc, step, status, msg, rows))
    return spark.createDataFrame(out, EVENT_SCHEMA)


def folded(spark, data):
    df = runlog.log_fold(events(spark, data))
    return {r["LogId"]: r.asDict() for r in df.collect()}


def test_fold_rules(spark):
    rows = folded(spark, [
        (1, "P", "Dates", "Start", None, None),
        (2, "P", None, "Success", "a - b", 1),
        (3, "P", "Code", "Start", "sql", None),
        (4, "P", "Changes", "Start", None, 0),     # closes Code with 0 rows
        (5, "P", "Update", "Start", None, 7),      # closes Changes with 7 rows
        (6, "P", None, "Success", None, 3),        # Update: Success, rows 3, message kept
        (7, "P", "Dates", "Start", None, None),    # Dates again, no rows: run 2
        (8, "P", None, "Failed", None, None),      # Failed overwrites message and rows
        (9, "P", "Code", "Start", None, None),     # Code is new in run 2
        (10, "P", "Dates", "Start", None, None),   # run 3; Code stays Running
        (11, "Q", None, "Success", "x", 5),        # no row yet: nothing happens
    ])
    assert rows[1]["Status"] == "Success" and rows[1]["Message"] == "a - b" and rows[1]["RowsProcessed"] == 1
    assert rows[3]["Status"] == "Success" and rows[3]["RowsProcessed"] == 0
    assert rows[3]["EndDateTime"] == d("2024-01-02 10:00:04")
    assert rows[4]["RowsProcessed"] == 7
    assert rows[5]["Status"] == "Success" and rows[5]["RowsProcessed"] == 3
    assert [rows[i]["Run"] for i in (1, 3, 4, 5, 7, 9, 10)] == [1, 1, 1, 1, 2, 2, 3]
    assert rows[7]["Status"] == "Failed" and rows[7]["Message"] is None and rows[7]["RowsProcessed"] is None
    assert rows[9]["Status"] == "Running" and rows[9]["EndDateTime"] is None
    assert rows[10]["Status"] == "Running"
    assert set(rows) == {1, 3, 4, 5, 7, 9, 10}


def test_fold_long_restart_chain(spark):
    # many restarts in one group exercise several pointer-doubling rounds
    data, seq = [], 0
    for _ in range(20):
        for step in ("Dates", "Code", "Insert"):
            seq += 1
            data.append((seq, "P", step, "Start", None, None if step != "Insert" else 1))
    rows = folded(spark, data)
    runs = [rows[i]["Run"] for i in sorted(rows)]
    assert runs == [r for r in range(1, 21) for _ in range(3)]


def test_summary_columns(spark):
    log = spark.createDataFrame(
        [
            (1, LD, 2, "P", "Dates", "Success", d("2024-01-02 10:00:00.9"), d("2024-01-02 10:00:01.1"), "m1", 1),
            (2, LD, 2, "P", "Insert", "Running", d("2024-01-02 10:00:02"), None, None, None),
            (3, LD, 2, "P", "X-Prepare", "Success", d("2024-01-02 10:00:03"), d("2024-01-03 10:00:05"), None, 0),
        ],
        "LogId bigint, LoadDate timestamp_ntz, Run smallint, Procedure string, Step string, Status string, "
        "StartDateTime timestamp_ntz, EndDateTime timestamp_ntz, Message string, RowsProcessed bigint",
    )
    s = runlog.log_summary(log).collect()[0]
    assert s["Load"] == "2024-01-01 00:00:00.000000 (Waiting)"
    assert s["Elapsed"] == "00:00:05"  # 24 h + 5 s, second boundaries, wraps at a day
    assert s["Status"] == "Running" and s["InProgress"] == "Insert" and s["Dates"] == "m1"
    assert s["RowsProcessed"] == 0 and s["RowsInserted"] == 0


def test_latest_keeps_newest_runs(spark):
    log = spark.createDataFrame(
        [(i, LD, i, "P", "Dates", "Success", d("2024-01-02") + dt.timedelta(hours=i), None, None, 1) for i in range(1, 8)],
        "LogId bigint, LoadDate timestamp_ntz, Run int, Procedure string, Step string, Status string, "
        "StartDateTime timestamp_ntz, EndDateTime timestamp_ntz, Message string, RowsProcessed bigint",
    )
    out = runlog.log_latest(log, n=3).collect()
    assert [r["Run"] for r in out] == [7, 6, 5]


def test_fold_with_hot_groups_split_matches_plain(spark):
    # every group counts as hot: all running scans are cut into parts
    from tidemark import fixtures as fx

    ev = fx.log_events(spark, "/root/testdata/sf0.001")
    plain = sorted(tuple(r) for r in runlog.log_fold(ev).collect())
    split = sorted(tuple(r) for r in runlog.log_fold(ev, hot_rows=3).collect())
    assert split == plain


def test_increments_equal_the_whole_fold(spark):
    """Random events of eight groups, cut in the middle of runs and of rows."""
    import random

    rng = random.Random(5)
    data = []
    for seq in range(1, 400, 3):
        status = rng.choice(["Start", "Start", "Success", "Failed"])
        step = rng.choice(["Dates", "Code", "Insert"]) if status == "Start" else None
        rows = rng.choice([None, None, 0, seq])
        data.append((seq, f"P{rng.randrange(8)}", step, status, rng.choice([None, f"m{seq}"]), rows))
    data.append((500, "New", "Dates", "Start", None, None))
    every = events(spark, data)
    log = runlog.log_fold(events(spark, []))
    for low, high in ((0, 120), (120, 250), (250, 1000)):
        log = runlog.fold_increment(log, every.where(f"seq > {low} and seq <= {high}")).checkpoint()
    got = sorted(map(str, log.collect()))
    assert got == sorted(map(str, runlog.log_fold(every).collect()))


def test_an_increment_folds_the_groups_with_new_events_only(spark):
    old = runlog.log_fold(events(spark, [(1, "P", "Dates", "Start", None, None), (2, "Q", "Dates", "Start", None, None)])).checkpoint()
    seen = []
    real = runlog.log_fold

    def fold(e, hot_rows=None):
        seen.append(e)
        return real(e, hot_rows)

    runlog.log_fold = fold
    try:
        log = runlog.fold_increment(old, events(spark, [(5, "Q", "Code", "Start", None, None)])).collect()
    finally:
        runlog.log_fold = real
    assert {r["Procedure"] for r in seen[0].collect()} == {"Q"}
    assert {(r["LogId"], r["Status"]) for r in log} == {(1, "Running"), (2, "Success"), (5, "Running")}


def test_a_fold_without_hot_groups_takes_few_jobs(spark):
    """Forty runs of one group; pointer doubling took a checkpoint and a count for each of its rounds."""
    rows = [(i, "P", "Dates", "Start", None, None) for i in range(1, 41)]
    spark.sparkContext.setJobGroup("fold", "fold")
    try:
        log = runlog.log_fold(events(spark, rows)).collect()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("fold")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r["Run"] for r in log) == list(range(1, 41))
    assert len(jobs) <= 25


def test_an_event_that_came_twice_repeats_no_step(spark):
    rows = [(1, "P", "Dates", "Start", None, None)] * 2 + [(2, "P", "Code", "Start", None, None)]
    assert {r["Run"] for r in runlog.log_fold(events(spark, rows)).collect()} == {1}
