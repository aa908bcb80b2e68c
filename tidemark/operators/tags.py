"""Tag tables: First, Latest and History versions per business key.

A tag table is a compact key -> version index.  It carries only the key
columns, the capture / lake timestamps and the action code of each change,
never the payload.  The functions here take the source, the current target
and the window bounds and return the change set as a DataFrame with an
``Upsert`` flag (``I`` insert / ``U`` update); they write no table, but
History checkpoints its combined versions on the way.
``merge.py`` turns a change set into the next target state.

Scale notes
* The window filter uses literal bounds, so it is pushed into the parquet
  scan.
* First and Latest reduce the window to one row per key with
  ``min/max(struct(...))`` before any join; the aggregate is combined
  map-side, so a hot key never gathers its rows in one task.
* Stored rows are fetched with a semi join driven by the change keys; the
  change keys are broadcast only under a counted size bound, so the large
  target is streamed, not shuffled.
* History first reduces to one version per ``(key, capture)`` with a
  map-side-combined aggregate; the expiry (next capture of the key) is a
  running minimum in which a key with very many versions is cut into
  ordered parts (``scan.py``) that run as separate tasks.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import epoch_micros, in_window, ntz
from tidemark.functions.constants import (
    ACTION,
    CAPTURE,
    EXPIRY,
    INSERT_FLAG,
    LAKE,
    OPEN_EXPIRY,
    TAG_LOW_DATE,
    UPDATE_FLAG,
    UPDATED,
    UPSERT,
)
from tidemark.operators.scan import running, with_parts
from tidemark.operators.sizing import bounded_broadcast

CHANGE_COLUMNS = (CAPTURE, LAKE, ACTION)


def empty_target(spark: SparkSession, source: DataFrame, keys: Sequence[str], kind: str) -> DataFrame:
    """An empty First / Latest / History table whose key types follow the source."""
    by_name = {f.name: f for f in source.schema.fields}
    fields = [T.StructField(k, by_name[k].dataType, True) for k in keys]
    ts = T.TimestampNTZType()
    fields.append(T.StructField(CAPTURE, ts, True))
    if kind == "history":
        fields.append(T.StructField(EXPIRY, ts, True))
    fields += [
        T.StructField(LAKE, ts, True),
        T.StructField(ACTION, by_name[ACTION].dataType if ACTION in by_name else T.StringType(), True),
        T.StructField(UPDATED, ts, True),
    ]
    return spark.createDataFrame([], T.StructType(fields))


def window_rows(source: DataFrame, keys: Sequence[str], low, high) -> DataFrame:
    """Changes whose lake timestamp is in ``(low, high]`` (pushed into the scan)."""
    return source.where(in_window(LAKE, low, high)).select(*keys, *CHANGE_COLUMNS)


def reduced_window(kind: str, source: DataFrame, keys: Sequence[str], low, high) -> DataFrame:
    """The window's changes that can matter to a target: one per key, or per key and capture for History.

    A loader gives the same change set from these rows as from all of the
    window, so a load reads its source once and works on this frame.
    """
    rows = window_rows(source, keys, low, high)
    if kind == "history":
        newest = rows.groupBy(*keys, CAPTURE).agg(F.max(F.struct(LAKE, ACTION)).alias("_v"))
        return newest.select(*keys, CAPTURE, F.col(f"_v.{LAKE}").alias(LAKE), F.col(f"_v.{ACTION}").alias(ACTION))
    pick = F.min if kind == "first" else F.max
    one = rows.groupBy(*keys).agg(pick(F.struct(*CHANGE_COLUMNS)).alias("_v"))
    return one.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in CHANGE_COLUMNS])


def stored_for_keys(
    target: DataFrame, probe: DataFrame, keys: Sequence[str], probe_rows: int | None = None
) -> DataFrame:
    """Target rows whose key occurs in ``probe`` (a semi join led by the changes)."""
    return target.join(bounded_broadcast(probe, probe_rows), list(keys), "left_semi")


def _flag(hit: Column) -> Column:
    return F.when(hit.isNull(), F.lit(INSERT_FLAG)).otherwise(F.lit(UPDATE_FLAG))


def first_changes(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    low: _dt.datetime,
    high: _dt.datetime,
    now: _dt.datetime,
    probe_rows: int | None = None,
) -> DataFrame:
    """Rows to append to a First table.

    Per key that the target does not hold yet, the lowest
    ``(capture, lake, action)`` in the window; existing keys never change.
    """
    firsts = (
        window_rows(source, keys, low, high)
        .groupBy(*keys)
        .agg(F.min(F.struct(*CHANGE_COLUMNS)).alias("_v"))
        .select(*keys, *[F.col(f"_v.{c}").alias(c) for c in CHANGE_COLUMNS])
    )
    known = stored_for_keys(target.select(*keys), firsts.select(*keys), keys, probe_rows)
    return firsts.join(known, list(keys), "left_anti").select(
        *keys, *CHANGE_COLUMNS, ntz(now).alias(UPDATED), F.lit(INSERT_FLAG).alias(UPSERT)
    )


def latest_changes(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    low: _dt.datetime,
    high: _dt.datetime,
    now: _dt.datetime,
    probe_rows: int | None = None,
) -> DataFrame:
    """Rows to upsert into a Latest table.

    Per key, the highest ``(capture, lake, action)`` in the window, unless it
    is older than the capture already stored (a late row).  An equal capture
    replaces the stored row.  The stored capture of a new key counts as
    1900-01-01, so a capture before that is dropped.
    """
    newest = (
        window_rows(source, keys, low, high)
        .groupBy(*keys)
        .agg(F.max(F.struct(*CHANGE_COLUMNS)).alias("_v"))
        .select(*keys, *[F.col(f"_v.{c}").alias(c) for c in CHANGE_COLUMNS])
    )
    stored = stored_for_keys(target, newest.select(*keys), keys, probe_rows).select(
        *keys, F.col(CAPTURE).alias("_stored_capture"), F.lit(True).alias("_hit")
    )
    joined = newest.join(stored, list(keys), "left").where(
        F.coalesce(F.col("_stored_capture"), ntz(TAG_LOW_DATE)) <= F.col(CAPTURE)
    )
    return joined.select(
        *keys, *CHANGE_COLUMNS, ntz(now).alias(UPDATED), _flag(F.col("_hit")).alias(UPSERT)
    )


def history_changes(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    low: _dt.datetime,
    high: _dt.datetime,
    now: _dt.datetime,
    probe_rows: int | None = None,
    refresh_action: bool = False,
    hot_rows: int | None = None,
    existing: Observation | None = None,
) -> DataFrame:
    """Rows to upsert into a History table (validity intervals per key).

    The window's changes (``I``) are combined with the stored versions whose
    interval ends after the earliest new capture of their key (``U``).  Each
    version's expiry is the next capture of its key (or 9999-12-31); a
    version whose expiry equals its capture (replaced by a newer lake row of
    the same capture) is dropped.  A surviving version with a stored
    counterpart updates it: new expiry and lake time, the stored action code
    (unless ``refresh_action``), and a new update time only if the lake time
    changed.  Ties on ``(capture, lake)`` are broken by action, then flag.
    ``existing`` observes how many stored versions take part (``rows``).

    The combined versions are checkpointed here (see below), so calling this
    runs a job; a dry run must not call it.
    """
    ts = T.TimestampNTZType()
    incoming = window_rows(source, keys, low, high).select(
        *keys,
        *CHANGE_COLUMNS,
        F.lit(INSERT_FLAG).alias(UPSERT),
        F.lit(None).cast(ts).alias("_old_lake"),
        F.lit(None).cast(target.schema[ACTION].dataType).alias("_old_action"),
        F.lit(None).cast(ts).alias("_old_updated"),
    )
    first_capture = incoming.groupBy(*keys).agg(F.min(CAPTURE).alias("_first_capture"))
    stored = (
        target.join(bounded_broadcast(first_capture, probe_rows), list(keys))
        .where(F.col("_first_capture") < F.col(EXPIRY))
        .select(
            *keys,
            *CHANGE_COLUMNS,
            F.lit(UPDATE_FLAG).alias(UPSERT),
            F.col(LAKE).alias("_old_lake"),
            F.col(ACTION).alias("_old_action"),
            F.col(UPDATED).alias("_old_updated"),
        )
    )
    if existing is not None:
        stored = stored.observe(existing, F.count(F.lit(1)).alias("rows"))
    combined = incoming.unionByName(stored)
    # One surviving version per (key, capture): the newest (lake, action,
    # flag); the others would expire at their own capture.  The aggregate is
    # combined map-side, so a hot (key, capture) is reduced before the shuffle.
    old = F.struct("_old_lake", "_old_action", "_old_updated")
    versions = (
        combined.where(F.col(CAPTURE).isNotNull())
        .groupBy(*keys, CAPTURE)
        .agg(
            F.max(F.struct(LAKE, ACTION, UPSERT)).alias("_top"),
            F.max(F.when(F.col(UPSERT) == UPDATE_FLAG, old)).alias("_old"),
        )
        .select(
            *keys,
            CAPTURE,
            F.col(f"_top.{LAKE}").alias(LAKE),
            F.col(f"_top.{ACTION}").alias(ACTION),
            F.when(F.col("_old").isNotNull(), F.lit(UPDATE_FLAG)).otherwise(F.lit(INSERT_FLAG)).alias("_flag"),
            "_old",
        )
    )
    # Expiry = the key's next capture: a reverse running minimum, split into
    # ordered parts so one key with very many versions is not one task.
    # Materialised once: the hot-key measurement and the plan both read it,
    # so the stored table is scanned once.
    versions = versions.checkpoint()
    parted = with_parts(versions, keys, epoch_micros(CAPTURE), hot_rows)
    ranked = (
        running(parted, keys, [CAPTURE], F.col(CAPTURE), "min", "_next", reverse=True, inclusive=False)
        .df.withColumn(EXPIRY, F.coalesce(F.col("_next"), ntz(OPEN_EXPIRY)))
        .where(F.col(CAPTURE) != F.col(EXPIRY))
    )
    is_update = F.col("_flag") == UPDATE_FLAG
    action = F.col(ACTION) if refresh_action else F.when(is_update, F.col("_old._old_action")).otherwise(F.col(ACTION))
    updated = F.when(is_update & (F.col(LAKE) == F.col("_old._old_lake")), F.col("_old._old_updated")).otherwise(ntz(now))
    return ranked.select(
        *keys,
        CAPTURE,
        EXPIRY,
        LAKE,
        action.alias(ACTION),
        updated.alias(UPDATED),
        F.col("_flag").alias(UPSERT),
    )
