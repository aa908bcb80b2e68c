"""Fixed values that must equal the original warehouse procedures.

Everything here is a literal that the incremental loaders, the run log and
the partition planner compare against; changing one changes results.
"""

from __future__ import annotations

import datetime as _dt

# --- fixed values: change-window defaults -----------------------------------
# Low bound used by the tag loaders (First / Latest / History) when a target
# is empty or a watermark value is NULL.
TAG_LOW_DATE = _dt.datetime(1900, 1, 1)
# Low bound used by the gold upsert when the target is empty.
GOLD_LOW_DATE = _dt.datetime(1899, 1, 1)
# Open end of a History validity interval (LEAD default).
OPEN_EXPIRY = _dt.datetime(9999, 12, 31)

# --- fixed values: change columns -------------------------------------------
CAPTURE = "CaptureTimestamp"
LAKE = "LakeTimestamp"
ACTION = "LakeActionCode"
EXPIRY = "ExpiryTimestamp"
UPDATED = "UpdateTimestamp"
UPSERT = "Upsert"
INSERT_FLAG = "I"
UPDATE_FLAG = "U"

# --- fixed values: naming conventions for pair discovery ---------------------
DERIVED_SUFFIX = "_Derived"
TAG_SCHEMA_SUFFIX = "_Tag"
FIRST_SUFFIX = "_First"
LATEST_SUFFIX = "_Latest"
HISTORY_SUFFIX = "_History"
SOURCE_OBJECT_TYPES = ("V", "U")
TABLE_TYPE = "U"
VIEW_TYPE = "V"
GOLD_TARGET_SCHEMAS = ("Dimension", "Fact", "Bridge", "Cache")
GOLD_SOURCE_SCHEMA = "Live"
WATERMARK_TABLE = "__high_watermark"

# --- fixed values: run log ----------------------------------------------------
STATUS_START = "Start"
STATUS_SUCCESS = "Success"
STATUS_FAILED = "Failed"
STATUS_RUNNING = "Running"
STEP_DATES = "Dates"
STEP_CODE = "Code"
STEP_FIRSTS = "Firsts"
STEP_CANDIDATES = "Candidates"
STEP_CHANGES = "Changes"
STEP_EXISTING = "Existing"
STEP_COMBINE = "Combine"
STEP_UPDATE = "Update"
STEP_INSERT = "Insert"
WAITING_SUFFIX = " (Waiting)"
LATEST_RUNS = 1000
# Step-name patterns of the summary view (SQL LIKE patterns).
PREPARE_PATTERNS = ("%-Prepare", "%Prepare")
INSERT_PATTERNS = ("%Insert", "%-Switch-New")
UPDATE_PATTERNS = ("%Update",)
DELETE_PATTERNS = ("%Delete",)
FAILURE_HEADER = "The following table(s) failed {me} processing:\r\n"
FAILURE_LINE = "\n\t{target} : \tError = {message}"

# --- fixed values: partition planning -----------------------------------------
DEFAULT_FIRST_BOUNDARY = _dt.datetime(2019, 1, 1)
DAILY = "D"
MONTHLY = "M"
MONTHLY_GAP_DAYS = 20
CURRENT_PARTITION = "9999-12-31 00:00:00.000"
LAST_EMPTY_PARTITION = "9999-12-31 23:59:59.999"
ACTION_INSERT = "Insert"
ACTION_MERGE = "Merge"
DAY_ZERO = _dt.date(1900, 1, 1)
DEFAULT_ROW_BOUNDARY = 4
CODEC_HOT = "ROW"
CODEC_COLD = "PAGE"
# Parquet codec used when a partition is rewritten into a tier.
TIER_PARQUET_CODEC = {CODEC_HOT: "snappy", CODEC_COLD: "zstd"}

# Text format of datetime2 values (style 121, with 6 instead of 7 digits).
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MS_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"
