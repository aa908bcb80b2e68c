"""Gold upsert: type-1 overwrite of a dimension / fact / bridge / cache table.

The source is a "Live" view with the same columns as the target, including
``UpdateTimestamp``.  Rows whose update time is in the window replace the
stored row of their key (all non-key, non-computed columns) or are inserted.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import in_window
from tidemark.functions.constants import INSERT_FLAG, UPDATE_FLAG, UPDATED, UPSERT
from tidemark.operators.sizing import bounded_broadcast
from tidemark.operators.tags import stored_for_keys


def upsert_candidates(source: DataFrame, keys: Sequence[str], low, high) -> DataFrame:
    """Distinct candidate (first key column) values changed in the window."""
    return source.where(in_window(UPDATED, low, high)).select(keys[0]).distinct()


def led_by_candidates(source: DataFrame, candidates: DataFrame, keys: Sequence[str], rows: int | None) -> DataFrame:
    """The source's rows of the candidate keys (``rows`` of them).

    Where the candidates fit a broadcast, Catalyst pushes this join on a
    grouping key below the aggregate of a Live view, so the view is computed
    for changed keys only. A filter on the aggregate's result would get
    between the two: materialise this frame before filtering it.
    """
    return source.join(bounded_broadcast(candidates, rows), [keys[0]], "left_semi")


def upsert_changes(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    low: _dt.datetime,
    high: _dt.datetime,
    now: _dt.datetime | None = None,
    probe_rows: int | None = None,
    candidate_filter: bool = False,
    computed: Mapping[str, str] | None = None,
) -> DataFrame:
    """Changed source rows with an ``Upsert`` flag (``I`` new key, ``U`` known key).

    ``candidate_filter`` adds the candidate-key semi join of the original
    procedure in the same plan; it changes no result (NULL keys are rejected
    anyway).  The drivers materialise the candidates first and pass the rows
    they lead to as ``source`` (``led_by_candidates``).
    """
    computed = dict(computed or {})
    columns = [c for c in target.columns if c not in computed]
    rows = source.where(in_window(UPDATED, low, high))
    if candidate_filter:
        rows = led_by_candidates(rows, upsert_candidates(source, keys, low, high), keys, probe_rows)
    rows = rows.select(*columns)
    stored = stored_for_keys(target.select(*keys), rows.select(*keys), keys, probe_rows).withColumn(
        "_hit", F.lit(True)
    )
    out = rows.join(stored, list(keys), "left").select(
        *columns,
        F.when(F.col("_hit").isNull(), F.lit(INSERT_FLAG)).otherwise(F.lit(UPDATE_FLAG)).alias(UPSERT),
    )
    for name, expr in computed.items():
        out = out.withColumn(name, F.expr(expr))
    return out.select(*target.columns, UPSERT)
