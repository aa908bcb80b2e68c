"""Bench: headline loader queries on local[$BENCH_CPUS] at $BENCH_SF_DIR.

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is written to a ``noop`` sink once to warm up (JIT, file listing)
and timed on a second run; the value is the sum of the timed runs. Loaders
also report the change rows in their windows per second.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark import catalog  # noqa: E402
from tidemark import fixtures as fx  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = (
    "tag_first_full",
    "tag_latest_full",
    "tag_history_full",
    "tag_first_initial",
    "tag_first_incremental",
    "tag_latest_initial",
    "tag_latest_incremental",
    "tag_history_initial",
    "tag_history_incremental",
    "dim_upsert_initial",
    "dim_upsert_incremental",
    "log_summary",
    "log_latest",
    "log_fold",
    "partition_plan",
    "partition_tiers",
    "control_latest_report",
)


def run(query, spark, sf_dir: str) -> int:
    """Compute every row of a query, keep none; returns their number."""
    seen = Observation()
    df = query(spark, sf_dir).observe(seen, F.count(F.lit(1)).alias("n"))
    df.write.format("noop").mode("overwrite").save()
    return seen.get["n"]


def window_rows(spark, sf_dir: str, name: str) -> int | None:
    """Change rows (Live view: orders) that a loader query's windows hold together."""
    batches = {"initial": 1, "incremental": 0, "full": 0}.get(name.rsplit("_", 1)[-1])
    if batches is None or not name.startswith(("tag_", "dim_")):
        return None
    if name.startswith("dim_"):
        orders = fx.table(spark, sf_dir, "orders")
        return orders.where(F.col("o_orderdate") <= F.lit(fx.LIVE_CUTOFFS[batches - 1])).count()
    last = F.lit(fx.BATCH_WATERMARKS[batches - 1])
    return fx.tag_source(spark, sf_dir).where(F.col("LakeTimestamp") <= last).count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = build_session(master=f"local[{cpus}]", app="tidemark-bench", shuffle_partitions=cpus)
    qs = catalog.queries()
    names = [n for n in HEADLINE if n in qs]
    if len(sys.argv) > 1:
        names = [n for n in sys.argv[1:] if n in qs]
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        run(qs[name], spark, sf_dir)  # warm-up
        t0 = time.perf_counter()
        rows[name] = run(qs[name], spark, sf_dir)
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s, {rows[name]} rows", file=sys.stderr)
    fed = {n: window_rows(spark, sf_dir, n) for n in times}
    rate = {n: round(fed[n] / t) for n, t in times.items() if fed[n] and t > 0}
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "window_rows_per_sec": rate,
        "sf": sf,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
