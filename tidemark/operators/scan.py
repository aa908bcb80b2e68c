"""Running aggregates over ordered groups, split so a hot group is not one task.

A window partitioned by a group key runs each whole group in one task.
When one group may hold a large share of all rows (one business key, one
procedure's log), the rows of such a group are cut into ordered parts:

* ``with_parts`` measures first: one map-side-combined aggregate finds the
  groups with more than ``hot_rows`` rows.  If there are none, the plain
  window plan is kept.  Otherwise approximate quantiles of each hot
  group's order value (``percentile_approx``, combined map-side) cut it
  into ``ceil(rows / hot_rows)`` ordered parts of similar size.  The cut
  points are checkpointed once (one row per hot group) and a row's part is
  a pure function of its value and those cut points, so every evaluation
  and retry assigns the same part.  The hot-group tables are
  broadcast under their counted size.
* ``running`` hash-partitions on ``(group, part)``, which spreads a hot
  group's parts over many tasks.
  It computes a running max / min / sum: inside each
  ``(group, part)`` with a window, plus - for hot groups only - a carry
  from the group's earlier parts (later ones with ``reverse``), read from a
  per-part aggregate with one row per hot (group, part).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sizing import bounded_broadcast

PART = "_part"
HOT = "_hot"
HOT_CONF = "tidemark.scan.hotRows"
DEFAULT_HOT_ROWS = 1_000_000

_AGG = {"max": F.max, "min": F.min, "sum": F.sum}


@dataclass
class Parted:
    """Rows with ``PART`` / ``HOT`` columns; ``split`` tells if any group is hot."""

    df: DataFrame
    group: tuple[str, ...]
    split: bool


def hot_rows_limit(df: DataFrame, hot_rows: int | None = None) -> int:
    if hot_rows:
        return hot_rows
    value = df.sparkSession.conf.get(HOT_CONF, None)
    return int(value) if value else DEFAULT_HOT_ROWS


CHUNK = 128


def with_parts(df: DataFrame, group: Sequence[str], order_value: Column, hot_rows: int | None = None) -> Parted:
    """Cut hot groups into ordered parts of about ``hot_rows`` rows (see module doc).

    ``order_value`` is a numeric image of the order (e.g. epoch micros of a
    timestamp); parts are contiguous, increasing ranges of it.  The cut
    points of a hot group are approximate quantiles of its order values, so
    parts hold similar row counts even when the values are tightly packed.
    """
    limit = hot_rows_limit(df, hot_rows)
    group = tuple(group)
    v = df.withColumn("_scan_o", order_value.cast("double"))
    hot = (
        v.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_scan_n"))
        .where(F.col("_scan_n") > limit)
        .select(*group, F.ceil(F.col("_scan_n") / F.lit(limit)).cast("int").alias("_scan_k"))
    )
    n_hot, most = hot.agg(F.count(F.lit(1)), F.max("_scan_k")).first()
    if n_hot == 0:
        return Parted(df.withColumn(PART, F.lit(0)).withColumn(HOT, F.lit(False)), group, False)
    hot = bounded_broadcast(hot, n_hot)
    # as many quantiles as the largest group has parts
    n_cuts = max(CHUNK, most)
    grid = F.lit([q / n_cuts for q in range(1, n_cuts)])
    cuts = (
        v.join(hot, list(group), "left_semi")
        .groupBy(*group)
        .agg(F.percentile_approx("_scan_o", grid, 10 * n_cuts).alias("_scan_cuts"))
        .withColumn("_scan_heads", F.filter("_scan_cuts", lambda c, i: i % CHUNK == 0))
        .join(hot, list(group))
        # sketch merges depend on fetch order: fix the cut points once
        .checkpoint()
    )
    j = v.join(bounded_broadcast(cuts, n_hot, row_bytes=64 * len(group) + 32 * n_cuts), list(group), "left")
    # rank of the value among the group's cut points (first the chunk, then
    # the place in it), scaled to k parts
    less = lambda cut_points: F.size(F.filter(cut_points, lambda c: c < F.col("_scan_o")))
    skipped = F.greatest(less(F.col("_scan_heads")) - 1, F.lit(0)) * CHUNK
    below = skipped + less(F.slice("_scan_cuts", skipped + 1, F.lit(CHUNK)))
    part = F.floor(below * F.col("_scan_k") / F.lit(n_cuts))
    return Parted(
        j.select(
            *df.columns,
            F.coalesce(part, F.lit(0)).cast("int").alias(PART),
            F.col("_scan_k").isNotNull().alias(HOT),
        ),
        group,
        True,
    )


def running(
    parted: Parted,
    group: Sequence[str],
    order: Sequence[str],
    value: Column,
    op: str,
    out: str,
    reverse: bool = False,
    inclusive: bool = True,
) -> Parted:
    """Add ``out`` = ``op`` of ``value`` over the group's rows up to this one.

    ``reverse`` runs from the end of the order (rows from this one on);
    ``inclusive=False`` leaves the current row out.  ``group`` must start
    with the parted group, so parts follow the order within each group.
    """
    agg = _AGG[op]
    sort = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    end = Window.currentRow if inclusive else -1
    if not parted.split:
        w = Window.partitionBy(*group).orderBy(*sort).rowsBetween(Window.unboundedPreceding, end)
        col = agg(value).over(w)
        if op == "sum":
            col = F.coalesce(col, F.lit(0))
        return Parted(parted.df.withColumn(out, col), parted.group, False)
    local_w = Window.partitionBy(*group, PART).orderBy(*sort).rowsBetween(Window.unboundedPreceding, end)
    # Hash on (group, part) explicitly: a partitioning on the group alone
    # would also satisfy the window and keep a hot group in one task.
    v = parted.df.repartition(*[F.col(c) for c in group], F.col(PART)).withColumn("_scan_v", value)
    local = v.withColumn("_scan_local", agg("_scan_v").over(local_w))
    per_part = v.where(F.col(HOT)).groupBy(*group, PART).agg(agg("_scan_v").alias("_scan_pv"))
    part_order = F.col(PART).desc() if reverse else F.col(PART).asc()
    carry_w = Window.partitionBy(*group).orderBy(part_order).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_part.select(*group, PART, agg("_scan_pv").over(carry_w).alias("_scan_carry"))
    # null-safe, as a window groups nulls together
    at = [*group, PART]
    carry = carry.select(*[F.col(c).alias(f"_scan_{c}") for c in at], "_scan_carry")
    same = [F.col(c).eqNullSafe(F.col(f"_scan_{c}")) for c in at]
    joined = local.join(carry, same, "left").drop(*[f"_scan_{c}" for c in at])
    a, b = F.col("_scan_local"), F.col("_scan_carry")
    if op == "max":
        combined = F.greatest(a, b)
    elif op == "min":
        combined = F.least(a, b)
    else:
        combined = F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    df = joined.withColumn(out, combined).drop("_scan_v", "_scan_local", "_scan_carry")
    return Parted(df, parted.group, True)
