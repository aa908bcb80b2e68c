"""Where the drivers find sources, targets, watermarks and the run log.

``Warehouse`` is the small interface the batch drivers use; two versions:

* ``FrameWarehouse`` holds DataFrames in a dict.  A commit replaces the
  entry with the checkpointed next state (no files of its own); tests and
  the query catalog use it.
* ``ParquetWarehouse`` keeps each declared table under
  ``<root>/<schema>/<object>`` as a ``KeyedParquetTable``; views are named
  DataFrame builders.  The run log is an append-only parquet dataset of
  step events under ``<root>/__log``, written as the events occur.  How far
  a target is loaded is a row beside the table, added only after a commit:
  a commit that stopped half way is repeated from the old bound, whatever
  rows it left behind.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.constants import CAPTURE, EXPIRY, TABLE_TYPE, VIEW_TYPE, WATERMARK_TABLE
from tidemark.sources.intervals import IntervalParquetTable
from tidemark.sources.tables import BUCKET, KeyedParquetTable, path_exists
from tidemark.spec import TableSpec, column_rows, described

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType(), False),
        T.StructField("EventTime", T.TimestampNTZType(), True),
        T.StructField("LoadDate", T.TimestampNTZType(), True),
        T.StructField("Procedure", T.StringType(), True),
        T.StructField("Step", T.StringType(), True),
        T.StructField("Status", T.StringType(), True),
        T.StructField("Message", T.StringType(), True),
        T.StructField("RowsProcessed", T.LongType(), True),
    ]
)

Name = tuple[str, str]


@dataclass
class FrameWarehouse:
    """An in-memory warehouse of DataFrames (dry runs, tests, the catalog)."""

    # Step row counts are not recorded (the catalog needs only the report).
    record_counts = False
    spark: SparkSession
    tables: dict[Name, DataFrame] = field(default_factory=dict)
    views: dict[Name, DataFrame] = field(default_factory=dict)
    specs: dict[Name, TableSpec] = field(default_factory=dict)
    events: list[tuple] = field(default_factory=list)

    def registry(self) -> DataFrame:
        rows = [(s, o, TABLE_TYPE) for (s, o) in self.tables]
        rows += [(s, o, VIEW_TYPE) for (s, o) in self.views]
        return self.spark.createDataFrame(rows, "schema_name string, object_name string, type string")

    def source(self, schema: str, name: str) -> DataFrame:
        if (schema, name) in self.views:
            return self.views[(schema, name)]
        return self.tables[(schema, name)]

    def target(self, schema: str, name: str) -> DataFrame:
        return self.tables[(schema, name)]

    def spec(self, schema: str, name: str) -> TableSpec:
        return self.specs[(schema, name)]

    def watermark(self, schema: str) -> DataFrame | None:
        return self.tables.get((schema, WATERMARK_TABLE))

    def commit(self, schema: str, name: str, kind: str, state: DataFrame, changes: DataFrame, rows: int) -> None:
        # materialised like a written table, so the next run reads it
        # instead of re-deriving every earlier run
        self.tables[(schema, name)] = state.checkpoint()

    def log(self, events: list[tuple]) -> None:
        self.events.extend(events)


def stored_specs(spark: SparkSession, root: str, names: list[Name]) -> dict[Name, tuple[TableSpec, T.StructType]]:
    """What ``ParquetWarehouse`` needs to open written targets again: keys and computed columns come from their files."""
    found = {}
    for schema, name in names:
        fields = spark.read.parquet(f"{root.rstrip('/')}/{schema}/{name}").schema.fields
        struct = T.StructType([f for f in fields if f.name != BUCKET])
        found[(schema, name)] = (TableSpec.of_schema(name, struct), struct)
    return found


class ParquetWarehouse:
    """Declared tables stored as keyed parquet directories under ``root``."""

    record_counts = True

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        specs: Mapping[Name, tuple[TableSpec, T.StructType]],
        views: Mapping[Name, Callable[[SparkSession], DataFrame]] | None = None,
        buckets: int = 16,
        by_interval_end: bool = False,
    ) -> None:
        """``by_interval_end`` keeps History tables by the year their versions end (``intervals.py``)."""
        self.by_interval_end = by_interval_end
        self.spark = spark
        self.root = root.rstrip("/")
        self.specs = {n: (spec, described(struct, spec)) for n, (spec, struct) in specs.items()}
        self.views = dict(views or {})
        self.buckets = buckets

    def _table(self, schema: str, name: str) -> KeyedParquetTable:
        spec, struct = self.specs[(schema, name)]
        path = f"{self.root}/{schema}/{name}"
        if self.by_interval_end and EXPIRY in struct.fieldNames():
            return IntervalParquetTable(self.spark, path, spec.keys, struct, CAPTURE, EXPIRY, self.buckets)
        return KeyedParquetTable(self.spark, path, spec.keys, struct, self.buckets)

    def registry(self) -> DataFrame:
        rows = [(s, o, TABLE_TYPE) for (s, o) in self.specs if o != WATERMARK_TABLE]
        rows += [(s, o, VIEW_TYPE) for (s, o) in self.views]
        return self.spark.createDataFrame(rows, "schema_name string, object_name string, type string")

    def source(self, schema: str, name: str) -> DataFrame:
        if (schema, name) in self.views:
            return self.views[(schema, name)](self.spark)
        return self._table(schema, name).read()

    def target(self, schema: str, name: str) -> DataFrame:
        return self._table(schema, name).read()

    def spec(self, schema: str, name: str) -> TableSpec:
        return self.specs[(schema, name)][0]

    def table_specs(self) -> DataFrame:
        """``Target, Column, Position, KeyPosition, Computed`` of every target, read from the stored columns' metadata."""
        rows = []
        for schema, name in sorted(self.specs):
            stored = self._table(schema, name).stored_fields()
            rows += [(f"{schema}.{name}", *r) for r in column_rows(stored)]
        columns = "Target string, Column string, Position int, KeyPosition int, Computed string"
        return self.spark.createDataFrame(rows, columns)

    def target_for(self, schema: str, name: str, changed: DataFrame) -> DataFrame:
        """The target's rows in the buckets of the keys in ``changed``.

        A key's stored rows live only in its hash bucket, so this is all a
        change set can match; the bucket ids (at most ``buckets``) are
        collected and prune the scan. Of a History table, closed versions
        that end by the least capture of their bucket's changes are left out.
        """
        table = self._table(schema, name)
        if isinstance(table, IntervalParquetTable):
            return table.overlapping(changed)
        ids = table.touched_buckets(changed.select(*table.keys))
        return table.read_buckets(ids)

    def watermark(self, schema: str) -> DataFrame | None:
        path = f"{self.root}/{schema}/{WATERMARK_TABLE}"
        if not path_exists(self.spark, path):
            return None
        return self.spark.read.parquet(path).agg(F.max("LakeTimestamp").alias("LakeTimestamp"))

    def set_watermark(self, schema: str, value: _dt.datetime | None) -> None:
        """Add a watermark row; the newest counts, so a watermark only rises."""
        df = self.spark.createDataFrame([(value,)], "LakeTimestamp timestamp_ntz")
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/{schema}/{WATERMARK_TABLE}")

    def _progress(self, schema: str, name: str) -> str:
        return f"{self.root}/{schema}/{name}.progress"

    def progress(self, schema: str, name: str) -> _dt.datetime | None:
        """The newest change timestamp of the finished commits (None: none)."""
        path = self._progress(schema, name)
        if not path_exists(self.spark, path):
            return None
        return self.spark.read.parquet(path).agg(F.max("loaded_to").alias("m")).first()["m"]

    def advance(self, schema: str, name: str, loaded_to: _dt.datetime | None) -> None:
        """Add a progress row (none without a change); call it after the commit."""
        if loaded_to is None:
            return
        df = self.spark.createDataFrame([(loaded_to,)], "loaded_to timestamp_ntz")
        df.coalesce(1).write.mode("append").parquet(self._progress(schema, name))

    def commit(self, schema: str, name: str, kind: str, state: DataFrame, changes: DataFrame, rows: int) -> None:
        table = self._table(schema, name)
        if kind == "first":
            table.append(changes)
        elif kind == "history":
            table.upsert(changes, [*table.keys, CAPTURE], rows)
        else:
            table.upsert(changes, table.keys, rows)

    def log(self, events: list[tuple]) -> None:
        if events:
            df = self.spark.createDataFrame(events, EVENT_SCHEMA).coalesce(1)
            df.write.mode("append").parquet(f"{self.root}/__log")

    def log_events(self) -> DataFrame:
        path = f"{self.root}/__log"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], EVENT_SCHEMA)
        return self.spark.read.schema(EVENT_SCHEMA).parquet(path)

