import datetime as dt

from pyspark.sql import functions as F

TAG_SCHEMA = "k bigint, CaptureTimestamp timestamp_ntz, LakeTimestamp timestamp_ntz, LakeActionCode string"
FIRST_SCHEMA = TAG_SCHEMA + ", UpdateTimestamp timestamp_ntz"
HISTORY_SCHEMA = (
    "k bigint, CaptureTimestamp timestamp_ntz, ExpiryTimestamp timestamp_ntz, "
    "LakeTimestamp timestamp_ntz, LakeActionCode string, UpdateTimestamp timestamp_ntz"
)


def d(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def rows(df, *cols):
    out = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in out.collect())


def by_key(df, key="k"):
    return {r[key]: r.asDict() for r in df.collect()}
