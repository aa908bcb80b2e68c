"""Change windows: which rows fall between a target and the high watermark.

A target's low bound is the newest change timestamp it already holds; the
high bound is the newest source timestamp that does not pass the watermark.
Only rows with ``low < ts <= high`` are processed.  Both bounds are brought
to the driver (two one-row aggregates) and go back into the plan as
literals, so the scan of the source prunes files and row groups.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ntz
from tidemark.functions.constants import LAKE, TAG_LOW_DATE


class WatermarkMissing(RuntimeError):
    """The target namespace has no high-watermark row."""


def _fmt(v: _dt.datetime | None) -> str:
    return "NULL" if v is None else v.strftime("%Y-%m-%d %H:%M:%S.%f")


@dataclass(frozen=True)
class ChangeWindow:
    date_from: _dt.datetime
    date_to: _dt.datetime
    watermark: _dt.datetime
    # Source rows with ``date_from < ts <= watermark``: an upper bound of the
    # change set, counted in the same job as ``date_to``.
    rows: int = 0

    @property
    def is_open(self) -> bool:
        """The gate: process only if the window is not empty."""
        return self.date_to > self.date_from

    @property
    def message(self) -> str:
        return f"{_fmt(self.date_from)} - {_fmt(self.date_to)}"


def read_high_watermark(watermark: DataFrame | None, default=TAG_LOW_DATE) -> _dt.datetime:
    """The value of a one-row watermark table; a NULL value means ``default``."""
    if watermark is None:
        raise WatermarkMissing("no high-watermark table")
    rows = watermark.select(LAKE).limit(1).collect()
    if not rows:
        raise WatermarkMissing("high-watermark table is empty")
    return rows[0][0] if rows[0][0] is not None else default


def change_window(
    source: DataFrame,
    target: DataFrame,
    ts_col: str,
    watermark: _dt.datetime,
    date_from: _dt.datetime | None = None,
    date_to: _dt.datetime | None = None,
    default: _dt.datetime = TAG_LOW_DATE,
) -> ChangeWindow:
    """Bounds of the next increment.

    * a given ``date_to`` below the watermark becomes the watermark;
    * ``date_from`` defaults to the newest ``ts_col`` of the target;
    * ``date_to`` is the newest source ``ts_col`` in ``[date_from, watermark]``
      (the caller's value is replaced), ``default`` when there is none.
    """
    if date_to is not None and date_to < watermark:
        watermark = date_to
    if date_from is None:
        date_from = target.agg(F.max(ts_col).alias("m")).first()["m"]
        if date_from is None:
            date_from = default
    c = F.col(ts_col)
    row = (
        source.where((c >= ntz(date_from)) & (c <= ntz(watermark)))
        .agg(F.max(ts_col).alias("m"), F.count(F.when(c > ntz(date_from), 1)).alias("n"))
        .first()
    )
    high = row["m"] if row["m"] is not None else default
    return ChangeWindow(date_from, high, watermark, int(row["n"]))
