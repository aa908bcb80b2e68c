"""Turn a change set into the next state of a keyed target (pure).

``next = (target rows not matched by a change) UNION (changes)``: a
type-1 upsert expressed as an anti join plus a union, which works on any
file format.  The writer in ``sources/tables.py`` applies it to the touched
key buckets only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.functions.constants import CAPTURE
from tidemark.operators.sizing import bounded_broadcast


def upsert(
    target: DataFrame,
    changes: DataFrame,
    match: Sequence[str],
    change_rows: int | None = None,
) -> DataFrame:
    """Replace the target rows matched on ``match`` and add the new ones."""
    matched = bounded_broadcast(changes.select(*match), change_rows)
    keep = target.join(matched, list(match), "left_anti")
    return keep.unionByName(changes.select(*target.columns))


def matched(target: DataFrame, changes: DataFrame, match: Sequence[str], change_rows: int | None = None) -> DataFrame:
    """The target rows that ``upsert`` would replace."""
    return target.join(bounded_broadcast(changes.select(*match), change_rows), list(match), "left_semi")


def append(target: DataFrame, changes: DataFrame) -> DataFrame:
    """First tables only ever grow."""
    return target.unionByName(changes.select(*target.columns))


def apply_first(target: DataFrame, changes: DataFrame, keys: Sequence[str], change_rows=None) -> DataFrame:
    return append(target, changes)


def apply_latest(target: DataFrame, changes: DataFrame, keys: Sequence[str], change_rows=None) -> DataFrame:
    return upsert(target, changes, keys, change_rows)


def apply_history(target: DataFrame, changes: DataFrame, keys: Sequence[str], change_rows=None) -> DataFrame:
    # An 'I' version never shares (key, capture) with a stored one, so
    # matching on all changes replaces exactly the 'U' versions.
    return upsert(target, changes, [*keys, CAPTURE], change_rows)


def apply_dimensional(target: DataFrame, changes: DataFrame, keys: Sequence[str], change_rows=None) -> DataFrame:
    return upsert(target, changes, keys, change_rows)
