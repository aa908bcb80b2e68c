"""Size-checked broadcast.

A side is broadcast only when its row count is known (counted by the caller,
usually on a persisted change set) and ``rows * estimated row width`` stays
under a byte limit.  Beyond the limit the join is left to a shuffle join,
which adaptive execution may still demote at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMIT_CONF = "tidemark.broadcast.maxBytes"
DEFAULT_LIMIT = 64 * 1024 * 1024

_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.DateType: 4,
    T.FloatType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def row_width(schema: T.StructType) -> int:
    """A pessimistic in-memory width of one row (strings count 64 bytes)."""
    total = 16
    for f in schema.fields:
        t = type(f.dataType)
        if t in _WIDTH:
            total += _WIDTH[t] + 8
        elif isinstance(f.dataType, T.DecimalType):
            total += 24
        else:
            total += 72
    return total


def broadcast_limit(spark: SparkSession) -> int:
    value = spark.conf.get(LIMIT_CONF, None)
    return int(value) if value else DEFAULT_LIMIT


def fits_broadcast(df: DataFrame, rows: int | None, row_bytes: int | None = None) -> bool:
    """``row_bytes`` replaces the estimate where rows hold arrays of known length."""
    if rows is None:
        return False
    return rows * (row_bytes or row_width(df.schema)) <= broadcast_limit(df.sparkSession)


def bounded_broadcast(df: DataFrame, rows: int | None, row_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its counted size is under the limit, else ``df``."""
    return F.broadcast(df) if fits_broadcast(df, rows, row_bytes) else df
