"""Column helpers shared by the operators.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none needs Python at run time.  Timestamps are
``TIMESTAMP_NTZ`` throughout, which keeps results independent of the
session time zone.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.constants import TS_TEXT


def _text(value: object) -> str:
    if isinstance(value, _dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(value, _dt.date):
        return value.strftime("%Y-%m-%d 00:00:00")
    return str(value)


def ntz(value: object) -> Column:
    """A ``TIMESTAMP_NTZ`` literal (constant-folded, so it prunes row groups)."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(_text(value)).cast("timestamp_ntz")


def in_window(ts: str | Column, low: object, high: object) -> Column:
    """Half-open change window ``low < ts <= high`` with literal bounds."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return (c > ntz(low)) & (c <= ntz(high))


def ts_text(c: str | Column) -> Column:
    """Render a timestamp as ``yyyy-MM-dd HH:mm:ss.ffffff`` (style 121)."""
    return F.date_format(c, TS_TEXT)


def epoch_micros(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a ``TIMESTAMP_NTZ`` value."""
    col = F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("MICROSECOND", ntz("1970-01-01 00:00:00"), col)


def epoch_seconds_floor(c: str | Column) -> Column:
    """Whole seconds since 1970 (floor), i.e. the value truncated to seconds."""
    return F.floor(epoch_micros(c) / F.lit(1_000_000)).cast("bigint")


def seconds_crossed(start: str | Column, end: str | Column) -> Column:
    """Second boundaries crossed between two timestamps (``DATEDIFF(s, a, b)``)."""
    return epoch_seconds_floor(end) - epoch_seconds_floor(start)


def time_of_day_text(seconds: Column) -> Column:
    """A second count as a ``HH:mm:ss`` time of day; wraps at 24 hours."""
    s = F.pmod(seconds, F.lit(86400))
    text = F.format_string(
        "%02d:%02d:%02d",
        (s / 3600).cast("int"),
        ((s % 3600) / 60).cast("int"),
        (s % 60).cast("int"),
    )
    return F.when(seconds.isNotNull(), text)


def like_any(c: str | Column, patterns: Iterable[str]) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    out = None
    for p in patterns:
        cond = col.like(p)
        out = cond if out is None else (out | cond)
    return out if out is not None else F.lit(False)


def struct_of(*names: str) -> Column:
    return F.struct(*[F.col(n) for n in names])
