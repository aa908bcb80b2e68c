"""The driver's run log under parallel pairs, and dry runs."""

import glob
import threading
import time

from helpers import HISTORY_SCHEMA, TAG_SCHEMA, d

from tidemark.plans import control
from tidemark.plans.incremental import loaded, window_of
from tidemark.sources.warehouse import ParquetWarehouse
from tidemark.spec import TableSpec


class Slow:
    """A log that takes its time, and fails now and then."""

    def __init__(self):
        self.rows, self.calls = [], 0

    def log(self, events):
        time.sleep(0.01)
        self.calls += 1
        if self.calls % 5 == 0:
            raise OSError("not now")
        self.rows.extend(events)


def test_no_event_is_lost_between_parallel_pairs():
    log, wh = control.EventLog(1), Slow()

    def pair(name):
        for n in range(20):
            log.add(None, name, f"s{n}", "Start", rows=n)
            try:
                log.flush(wh)
            except OSError:
                pass

    threads = [threading.Thread(target=pair, args=(f"p{i}",)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    wh.calls = 0
    log.flush(wh)
    assert sorted(r[0] for r in wh.rows) == list(range(1, 161))
    assert len({(r[3], r[4]) for r in wh.rows}) == 160


def _warehouse(spark, scratch):
    rows = [(k, d("2020-01-01"), d(f"2021-01-{k:02d}"), "I") for k in range(1, 10)]
    path = f"{scratch}/feed"
    spark.createDataFrame(rows, TAG_SCHEMA).write.parquet(path)
    schema = spark.createDataFrame([], HISTORY_SCHEMA).schema
    wh = ParquetWarehouse(
        spark, f"{scratch}/wh", {("S_Tag", "T_History"): (TableSpec("T_History", ("k",)), schema)},
        views={("S", "T"): lambda s: s.read.parquet(path)}, buckets=2,
    )
    wh.set_watermark("S_Tag", d("2022-01-01"))
    return wh


def test_a_dry_run_of_an_open_window_writes_nothing(spark, scratch):
    wh = _warehouse(spark, scratch)
    folder = spark.sparkContext.getCheckpointDir().replace("file:", "")
    before = sorted(glob.glob(f"{folder}/**", recursive=True))
    report = control.run_control("history", wh, date_limit=d("2022-01-01"), now=d("2024-01-01"), dry_run=True)
    assert report.rows[0].date_to > report.rows[0].date_from
    assert set(glob.glob(f"{folder}/**", recursive=True)) <= set(before)
    assert wh.target("S_Tag", "T_History").isEmpty() and wh.progress("S_Tag", "T_History") is None
    steps = [r["Step"] for r in wh.log_events().orderBy("seq").collect()]
    assert steps == ["Dates", None, "Code", None]


def test_the_window_is_read_once(spark, scratch, monkeypatch):
    """After the bounds only the reduced frame reads the source."""
    wh = _warehouse(spark, scratch)
    plans = []
    real = control._observed

    def observed(df, *metrics):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, *metrics)

    monkeypatch.setattr(control, "_observed", observed)
    seen = []
    monkeypatch.setattr(wh, "target_for", lambda s, n, changed, f=wh.target_for: (seen.append(changed), f(s, n, changed))[1])
    control.run_control("history", wh, date_limit=d("2022-01-01"), now=d("2024-01-01"))
    assert len(plans) == 2 and "Relation" in plans[0] and "Relation" not in plans[1]
    assert all("Relation" not in f._jdf.queryExecution().optimizedPlan().toString() for f in seen)
    assert wh.target("S_Tag", "T_History").count() == 9


def test_reduced_window_gives_the_same_changes(spark):
    from tidemark.operators.tags import empty_target, reduced_window

    rows = [(k % 3, d(f"2020-01-{1 + n % 4:02d}"), d(f"2021-01-{1 + n:02d}"), "IUD"[n % 3]) for k in range(3) for n in range(9)]
    src = spark.createDataFrame(rows, TAG_SCHEMA)
    for kind in ("first", "latest", "history"):
        tgt = empty_target(spark, src, ("k",), kind)
        w = window_of(kind, src, tgt, d("2021-01-07"))
        whole = loaded(kind, src, tgt, ("k",), w, d("2024-01-01")).changes
        small = loaded(kind, reduced_window(kind, src, ("k",), w.date_from, w.date_to), tgt, ("k",), w, d("2024-01-01")).changes
        assert sorted(map(str, whole.collect())) == sorted(map(str, small.collect()))
