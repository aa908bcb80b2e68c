"""One incremental step of a loader, as DataFrames.

``step`` = bounds -> change set -> next state.  It has no side effects, so
it serves three callers: the dry run (look at the change set), the query
catalog (chains of steps over in-memory states) and the table writer
(``sources/tables.py``), which persists the next state.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.functions.constants import GOLD_LOW_DATE, LAKE, TAG_LOW_DATE, UPDATED
from tidemark.operators import dimensional, merge, tags
from tidemark.operators.bounds import ChangeWindow, change_window


@dataclass(frozen=True)
class Loader:
    """How one kind of target is loaded."""

    name: str
    ts_col: str
    default_low: _dt.datetime
    changes: Callable[..., DataFrame]
    apply: Callable[..., DataFrame]


LOADERS: dict[str, Loader] = {
    "first": Loader("first", LAKE, TAG_LOW_DATE, tags.first_changes, merge.apply_first),
    "latest": Loader("latest", LAKE, TAG_LOW_DATE, tags.latest_changes, merge.apply_latest),
    "history": Loader("history", LAKE, TAG_LOW_DATE, tags.history_changes, merge.apply_history),
    "dimensional": Loader(
        "dimensional", UPDATED, GOLD_LOW_DATE, dimensional.upsert_changes, merge.apply_dimensional
    ),
}


@dataclass
class StepResult:
    window: ChangeWindow
    changes: DataFrame | None
    state: DataFrame


def window_of(
    kind: str,
    source: DataFrame,
    target: DataFrame,
    watermark: _dt.datetime,
    date_from: _dt.datetime | None = None,
    date_to: _dt.datetime | None = None,
) -> ChangeWindow:
    """Bounds of the target's next increment."""
    loader = LOADERS[kind]
    return change_window(source, target, loader.ts_col, watermark, date_from, date_to, loader.default_low)


def loaded(
    kind: str,
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    window: ChangeWindow,
    now: _dt.datetime,
    probed: DataFrame | None = None,
    **options,
) -> StepResult:
    """Change set and next state of an open window.

    ``probed`` may give the part of the target that can hold the window's
    keys (e.g. their hash buckets); the change set is computed against it.
    """
    loader = LOADERS[kind]
    options.setdefault("probe_rows", window.rows)
    at = target if probed is None else probed
    changes = loader.changes(source, at, keys, window.date_from, window.date_to, now, **options)
    # History's changes also hold stored versions, so the window bounds nothing
    state = loader.apply(target, changes, keys, None if kind == "history" else window.rows)
    return StepResult(window, changes, state)


def step(
    kind: str,
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    watermark: _dt.datetime,
    now: _dt.datetime,
    date_from: _dt.datetime | None = None,
    date_to: _dt.datetime | None = None,
    probe_target: Callable[[ChangeWindow], DataFrame] | None = None,
    **options,
) -> StepResult:
    """Bounds, change set and next state of one target (pure).

    ``probe_target`` may give, once the window is known, the part of the
    target that can hold the window's keys (e.g. their hash buckets); the
    change set is computed against it, the bounds against the whole target.
    """
    window = window_of(kind, source, target, watermark, date_from, date_to)
    if not window.is_open:
        return StepResult(window, None, target)
    probed = probe_target(window) if probe_target is not None else None
    return loaded(kind, source, target, keys, window, now, probed, **options)


def chain(
    kind: str,
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    watermarks: Sequence[_dt.datetime],
    nows: Sequence[_dt.datetime],
    materialize: bool = True,
    **options,
) -> list[StepResult]:
    """Successive steps, one per (watermark, now), each on the previous state.

    With ``materialize`` each intermediate state is checkpointed to the
    shared checkpoint folder, as a real run writes its target: the next
    batch then reads the state instead of re-deriving all earlier batches.
    """
    out: list[StepResult] = []
    for n, (wm, now) in enumerate(zip(watermarks, nows, strict=True), start=1):
        r = step(kind, source, target, keys, wm, now, **options)
        if materialize and n < len(watermarks) and r.changes is not None:
            r = StepResult(r.window, r.changes, r.state.checkpoint())
        out.append(r)
        target = r.state
    return out
