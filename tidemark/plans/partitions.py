"""Date-partition planning: wanted boundaries, insert/merge plan, hot/cold tiers.

On Spark a "partition" is a value of a date partition column of a
dataset.  The planner compares the boundaries a dataset should have (a
daily or monthly spine up to a high boundary) with the ones it has, and
lists the boundaries to add (``Insert``) or fold away (``Merge``).  The
tier step marks all but the newest ``row_boundary`` partitions as cold
(``PAGE`` in the original, ``zstd`` here) and the newest ones and the first
as hot (``ROW`` / ``snappy``); ``rewrite_tiers`` rewrites only the
partitions whose tier changes, with dynamic partition overwrite.

The plan and tier tables are small by construction (one row per calendar
period or partition), so their global row numbers are cheap; the data
itself is touched only by ``tier_rows`` / ``rewrite_tiers``.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ntz
from tidemark.functions.constants import (
    ACTION_INSERT,
    ACTION_MERGE,
    CODEC_COLD,
    CODEC_HOT,
    CURRENT_PARTITION,
    DAILY,
    DAY_ZERO,
    DEFAULT_FIRST_BOUNDARY,
    DEFAULT_ROW_BOUNDARY,
    LAST_EMPTY_PARTITION,
    MONTHLY,
    MONTHLY_GAP_DAYS,
    MS_TEXT,
    TIER_PARQUET_CODEC,
)
from tidemark.operators.sizing import bounded_broadcast
from tidemark.sources.versions import VersionedPartitions, value_in_path

OPEN_VALUE = "9999-12-31 00:00:00"


def existing_boundaries(data: DataFrame, partition_col: str) -> DataFrame:
    """The boundaries a dataset has: distinct values of its partition column.

    On a file-partitioned dataset the scan reads no data column: the value
    comes from the directory names, the row counts from the file footers.
    """
    return data.select(F.col(partition_col).cast("timestamp_ntz").alias("Value")).distinct()


def grain_stats(values: DataFrame, col: str = "Value") -> DataFrame:
    """Count, first, last and inferred grain of existing boundaries.

    Over values before 9999-12-31: at most one value, or an average gap of
    more than 20 days (integer division), means monthly; else daily.
    """
    v = values.where(F.col(col) < ntz(OPEN_VALUE))
    s = v.agg(
        F.count(col).alias("n"),
        F.min(col).alias("first_value"),
        F.max(col).alias("last_value"),
    )
    gap = F.datediff(F.col("last_value").cast("date"), F.col("first_value").cast("date"))
    grain = (
        F.when(F.col("n") <= 1, F.lit(MONTHLY))
        .when(F.floor(gap / (F.col("n") - 1)) > MONTHLY_GAP_DAYS, F.lit(MONTHLY))
        .otherwise(F.lit(DAILY))
    )
    return s.select("n", "first_value", "last_value", grain.alias("grain"))


@dataclass(frozen=True)
class PlanBounds:
    grain: str
    low: _dt.datetime
    high: _dt.datetime


def plan_bounds(
    values: DataFrame,
    boundary: _dt.datetime | None = None,
    grain: str | None = None,
    first_boundary: _dt.datetime | None = None,
    today: _dt.date | None = None,
    col: str = "Value",
) -> PlanBounds:
    """Grain and the range ``[low, high]`` to manage (one small aggregate)."""
    if boundary is None:
        today = today or _dt.datetime.now(_dt.timezone.utc).date()
        boundary = _dt.datetime.combine(today + _dt.timedelta(days=1), _dt.time())
    return bounds_from_stats(grain_stats(values, col).first(), boundary, grain, first_boundary)


def bounds_from_stats(row, boundary: _dt.datetime, grain: str | None = None, first_boundary=None) -> PlanBounds:
    """``plan_bounds`` from an already collected ``grain_stats`` row."""
    g = grain if grain is not None else row["grain"]
    if g != DAILY:
        g = MONTHLY
    low = first_boundary or row["first_value"] or DEFAULT_FIRST_BOUNDARY
    return PlanBounds(g, low, boundary)


def boundary_spine(spark: SparkSession, bounds: PlanBounds) -> DataFrame:
    """Wanted boundaries: from the start of the low period, one per period,
    up to and including the first boundary after ``high``."""
    low = bounds.low
    if bounds.grain == DAILY:
        unit, start = "DAY", low
    else:
        unit, start = "MONTH", _dt.datetime(low.year, low.month, 1)
    first, high = ntz(start), ntz(bounds.high)
    stop = F.greatest(first, F.timestamp_add(unit, F.lit(1), high))
    step = F.expr(f"interval 1 {unit.lower()}")
    spine = spark.range(1).select(F.explode(F.sequence(first, stop, step)).alias("Boundary"))
    # a value is wanted if it is the start or its predecessor is within high
    prev_within = F.timestamp_add(unit, F.lit(-1), F.col("Boundary")) <= high
    return spine.where((F.col("Boundary") == first) | prev_within)


def partition_plan(
    spark: SparkSession,
    values: DataFrame,
    bounds: PlanBounds,
    gap_fill: bool = False,
    trim: bool = False,
    col: str = "Value",
) -> DataFrame:
    """Boundaries present on exactly one side, kept by action and option.

    ``Insert`` is kept beyond ``high`` always, elsewhere only with
    ``gap_fill``; ``Merge`` only with ``trim``.  ``i`` numbers the rows by
    signed day count (inserts negative) descending; executing from the last
    ``i`` back runs inserts newest first, then merges oldest first.
    """
    wanted = boundary_spine(spark, bounds).select("Boundary", F.lit(ACTION_INSERT).alias("src"))
    sentinels = spark.range(1).select(
        F.explode(F.array(F.lit(LAST_EMPTY_PARTITION), F.lit(CURRENT_PARTITION))).alias("b")
    ).select(F.col("b").cast("timestamp_ntz").alias("Boundary"), F.lit(ACTION_INSERT).alias("src"))
    existing = values.select(F.col(col).alias("Boundary"), F.lit(ACTION_MERGE).alias("src"))
    grouped = (
        wanted.unionByName(sentinels)
        .unionByName(existing)
        .groupBy("Boundary")
        .agg(F.count(F.lit(1)).alias("n"), F.max("src").alias("Action"))
    )
    high = ntz(bounds.high)
    keep = (F.col("n") != 2) & (
        ((F.col("Action") == ACTION_INSERT) & (F.col("Boundary") > high))
        | ((F.col("Action") == ACTION_INSERT) & F.lit(bool(gap_fill)))
        | ((F.col("Action") == ACTION_MERGE) & F.lit(bool(trim)))
    )
    days = F.datediff(F.col("Boundary").cast("date"), F.lit(DAY_ZERO.isoformat()).cast("date"))
    signed = days * F.when(F.col("Action") == ACTION_INSERT, F.lit(-1)).otherwise(F.lit(1))
    order = Window.orderBy(signed.desc(), F.col("Boundary").asc())
    return grouped.where(keep).select(
        F.row_number().over(order).alias("i"),
        F.date_format("Boundary", MS_TEXT).alias("Boundary"),
        "Action",
    )


def partition_tiers(
    partitions: DataFrame,
    row_boundary: int | None = DEFAULT_ROW_BOUNDARY,
    schema: str | None = None,
    table: str | None = None,
) -> DataFrame | None:
    """Partitions whose compression tier must change.

    ``partitions``: ``SchemaName, ObjectName, PartitionNumber,
    CurrentCompression``.  Partition 1 is hot; a partition at least
    ``row_boundary`` below its dataset's newest is cold; the rest are hot.
    ``row_boundary=None`` means: leave tiers alone.
    """
    if row_boundary is None:
        return None
    p = partitions
    if table is not None:
        p = p.where(F.col("ObjectName") == table)
    if schema is not None:
        p = p.where(F.col("SchemaName") == schema)
    newest = F.max("PartitionNumber").over(Window.partitionBy("SchemaName", "ObjectName"))
    target = (
        F.when(F.col("PartitionNumber") == 1, F.lit(CODEC_HOT))
        .when(newest - F.lit(row_boundary) >= F.col("PartitionNumber"), F.lit(CODEC_COLD))
        .otherwise(F.lit(CODEC_HOT))
    )
    changed = p.select("SchemaName", "ObjectName", "PartitionNumber", "CurrentCompression", target.alias("TargetCompression")).where(
        F.col("TargetCompression") != F.col("CurrentCompression")
    )
    order = Window.orderBy(F.col("SchemaName").desc(), F.col("ObjectName").desc(), F.col("PartitionNumber").desc())
    return changed.select(
        F.row_number().over(order).alias("i"),
        "SchemaName",
        "ObjectName",
        "PartitionNumber",
        "TargetCompression",
    )


def partition_listing(files: DataFrame, value_col: str, schema_col: str = "SchemaName", table_col: str = "ObjectName") -> DataFrame:
    """The partitions of stored datasets, with their codec, from file metadata alone.

    ``files``: ``path, length`` (``sources.versions.file_listing``). Dataset
    and partition value are read from the path; the codec from the ending
    Spark's writer gives a file. ``CurrentCompression`` is the tier of that
    codec, ``NONE`` for another or no codec and ``MIXED`` if the files of a
    partition differ, so that such a partition is rewritten.
    ``PartitionNumber`` counts a dataset's values upwards. One row per file
    is read, one per partition returned.
    """
    codec = F.regexp_extract("path", r"\.([a-z0-9]+)\.parquet$", 1)
    tier = F.lit("NONE")
    for name, stored_as in TIER_PARQUET_CODEC.items():
        tier = F.when(codec == stored_as, F.lit(name)).otherwise(tier)
    parts = files.select(
        value_in_path(schema_col).alias("SchemaName"),
        value_in_path(table_col).alias("ObjectName"),
        value_in_path(value_col).cast("timestamp_ntz").alias("PartitionValue"),
        tier.alias("tier"),
        "length",
    )
    parts = parts.groupBy("SchemaName", "ObjectName", "PartitionValue").agg(
        F.count(F.lit(1)).alias("Files"), F.sum("length").alias("Bytes"), F.min("tier").alias("_low"), F.max("tier").alias("_high")
    )
    n = F.row_number().over(Window.partitionBy("SchemaName", "ObjectName").orderBy("PartitionValue"))
    return parts.select(
        "SchemaName", "ObjectName", n.alias("PartitionNumber"), "PartitionValue",
        F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.lit("MIXED")).alias("CurrentCompression"),
        "Files", "Bytes",
    )


def tier_rows(data: DataFrame, tiers: DataFrame, on: list[str]) -> DataFrame:
    """The data rows of partitions whose tier changes, with the target tier.

    ``tiers`` has one row per partition whose tier changes. The values of
    the last column of ``on`` (the partition column) are collected and prune
    the scan; the tier comes by a join, broadcast under the size limit.
    """
    t = tiers.drop("i")
    pruned, rows = _in_partitions(data, t, on[-1])
    return pruned.join(bounded_broadcast(t, rows), on, "inner")


def _in_partitions(data: DataFrame, listed: DataFrame, col: str) -> tuple[DataFrame, int]:
    """Rows in the listed partitions (a partition filter), and the number listed."""
    found = listed.groupBy(col).count().collect()
    literals = [ntz(r[col]) if isinstance(r[col], _dt.datetime) else F.lit(r[col]) for r in found]
    return data.where(F.col(col).isin(literals)), sum(r["count"] for r in found)


def merge_targets(values: DataFrame, plan: DataFrame, col: str = "Value") -> DataFrame:
    """``col, Neighbour``: where the rows of each merged boundary go.

    The neighbour is the next boundary below that stays, or, below the first
    that stays, that one; if none stays the rows keep their value. One row
    per partition, so the window is small.
    """
    merged = plan.where(F.col("Action") == ACTION_MERGE).select(
        F.col("Boundary").cast("timestamp_ntz").alias(col), F.lit(True).alias("_merged")
    )
    v = values.join(merged, col, "left")
    stays = F.when(F.col("_merged").isNull(), F.col(col))
    by_value = Window.orderBy(col)
    below = F.last(stays, ignorenulls=True).over(by_value.rowsBetween(Window.unboundedPreceding, 0))
    above = F.first(stays, ignorenulls=True).over(by_value.rowsBetween(0, Window.unboundedFollowing))
    v = v.withColumn("Neighbour", F.coalesce(below, above, F.col(col)))
    return v.where(F.col("_merged")).select(col, "Neighbour")


def merged_rows(data: DataFrame, targets: DataFrame, col: str) -> DataFrame:
    """The data rows of merged partitions, with the value they move to as ``Neighbour``.

    Only merged partitions are read. ``apply_merge`` commits the move.
    """
    pruned, rows = _in_partitions(data, targets, col)
    return pruned.join(bounded_broadcast(targets, rows), col)


def _folders_of(dataset: VersionedPartitions, listed: DataFrame, keys: list[str]) -> list[str]:
    """The dataset's folders whose partition values occur in ``listed`` (both sides are metadata)."""
    names = dataset.spark.createDataFrame([(f, "/" + f) for f in dataset.folders()], "folder string, path string")
    types = {f.name: f.dataType for f in dataset.schema.fields}
    at = names.select("folder", *[value_in_path(k).cast(types[k]).alias(k) for k in keys])
    return [r["folder"] for r in at.join(listed.select(*keys).distinct(), keys, "left_semi").collect()]


def apply_merge(dataset: VersionedPartitions, targets: DataFrame, col: str) -> int:
    """Fold the merged partitions into their neighbours, in one commit.

    ``targets`` (``col, Neighbour``, see ``merge_targets``). Only merged
    partitions are read and written; a neighbour keeps its files and gets
    those of the rows that move to it.
    """
    targets = targets.checkpoint()
    moved = merged_rows(dataset.read(), targets, col).withColumn(col, F.col("Neighbour"))
    return dataset.commit([(moved, None)], _folders_of(dataset, targets, [col]))


def apply_tiers(dataset: VersionedPartitions, tiers: DataFrame, on: list[str]) -> int:
    """Rewrite the partitions whose tier changes with their new codec, all in one commit.

    ``tiers``: the columns ``on`` (the partition column last) and
    ``TargetCompression``. Other partitions keep their files.
    """
    tiers = tiers.select(*on, "TargetCompression").checkpoint()
    rows = tier_rows(dataset.read(), tiers, on)
    parts = [
        (rows.where(F.col("TargetCompression") == tier), codec)
        for tier, codec in TIER_PARQUET_CODEC.items()
    ]
    return dataset.commit(parts, _folders_of(dataset, tiers, on))


def rewrite_tiers(rows: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Rewrite the listed partitions of a parquet dataset with their tier's codec.

    One dynamic-overwrite write per tier: only partitions present in
    ``rows`` are replaced.  ``rows`` must not be read lazily from ``path``
    itself (checkpoint it first).
    """
    for tier, codec in TIER_PARQUET_CODEC.items():
        part = rows.where(F.col("TargetCompression") == tier).drop("TargetCompression")
        (
            part.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", codec)
            .partitionBy(*partition_cols)
            .parquet(path)
        )
