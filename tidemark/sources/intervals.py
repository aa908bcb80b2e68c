"""History tables on parquet: open versions apart from closed ones, one commit per change.

A table of validity intervals lies in ``_bucket=<n>/_until=<year of the
interval's end>`` folders. Open versions end in 9999, so they are a partition
of their own in each bucket. A batch whose captures come after all stored ones
reads and rewrites open versions only; versions that it closes are added to
their year without rewriting it. A late batch also reaches closed versions:
those that end after its least capture, told by folder and by a filter that is
pushed into the scan.

The partitions are kept by ``VersionedPartitions``: a change writes new folders
and shows with one new version list, at once or not at all, and a repeated
load finds either the old rows or the new ones. A partition that has come to
lie in more than ``MAX_FOLDERS`` folders is rewritten into one by the next
change that touches its bucket. Folders that no version lists any more stay.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import ntz
from tidemark.operators import merge
from tidemark.sources.tables import BUCKET, KeyedParquetTable, bucket_of, path_exists
from tidemark.sources.versions import VersionedPartitions

UNTIL = "_until"
MAX_FOLDERS = 16
_PLACE = re.compile(rf"{BUCKET}=(\d+)/{UNTIL}=(\d+)$")


class IntervalParquetTable(KeyedParquetTable):
    """A keyed table of intervals that begin at ``start`` and end at ``end``."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        schema: T.StructType,
        start: str,
        end: str,
        buckets: int = 16,
    ) -> None:
        super().__init__(spark, path, keys, schema, buckets)
        self.start, self.end = start, end
        placed = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(UNTIL, T.IntegerType())])
        self.parts = VersionedPartitions(spark, path, placed, [BUCKET, UNTIL])

    def _pin_buckets(self) -> None:
        if not self._pinned and not self.exists() and path_exists(self.spark, self.path):
            raise ValueError(f"{self.path} is stored as one keyed dataset, not by interval ends")
        super()._pin_buckets()

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.parts.path}/versions")

    def read(self) -> DataFrame:
        return self.parts.read().drop(BUCKET, UNTIL)

    def places(self) -> dict[tuple[int, int], list[str]]:
        """The folders of each (bucket, year) in the newest version: metadata."""
        found: dict[tuple[int, int], list[str]] = {}
        for folder in self.parts.folders():
            at = _PLACE.search(folder)
            found.setdefault((int(at[1]), int(at[2])), []).append(folder)
        return found

    def _least(self, rows: DataFrame, col: str) -> dict:
        """The least ``col`` of each bucket that the rows touch (at most ``buckets`` rows)."""
        self._pin_buckets()
        least = rows.groupBy(bucket_of(self.keys, self.buckets).alias(BUCKET)).agg(F.min(col).alias("least"))
        return {r[BUCKET]: r["least"] for r in least.collect() if r["least"] is not None}

    def _ending_from(self, places: dict, least: dict) -> DataFrame:
        """Stored versions that end at a bucket's least time or later, and some that end between these times."""
        chosen = [f for (b, year), folders in places.items() if b in least and year >= least[b].year for f in folders]
        rows = self.parts.read_folders(chosen)
        return rows.where(F.col(self.end) >= ntz(min(least.values()))) if chosen else rows

    def overlapping(self, changes: DataFrame) -> DataFrame:
        """Stored versions that a change can touch: they end after the least start in its bucket."""
        return self._ending_from(self.places(), self._least(changes, self.start)).drop(BUCKET, UNTIL)

    def _with_bucket(self, df: DataFrame) -> DataFrame:
        return super()._with_bucket(df).withColumn(UNTIL, F.year(self.end))

    def _add(self, placed: DataFrame) -> None:
        self.parts.commit([(placed, None)])

    def upsert(self, changes: DataFrame, match: Sequence[str], change_rows: int | None = None) -> None:
        """Replace the versions matched on ``match`` and add the new ones, in one commit.

        A change only brings an interval's end forward, so what it replaces
        ended no earlier than the least end among the bucket's changes.
        """
        if not self.exists():
            self.append(changes)
            return
        least = self._least(changes, self.end)
        if not least:
            return
        places = self.places()
        new = self._with_bucket(changes)
        matched = merge.matched(self._ending_from(places, least), new, match, change_rows)
        replaced = {(r[BUCKET], r[UNTIL]) for r in matched.select(BUCKET, UNTIL).distinct().collect()}
        replaced |= {p for p, folders in places.items() if p[0] in least and len(folders) > MAX_FOLDERS}
        dropped = [f for p in replaced for f in places[p]]
        self.parts.commit([(merge.upsert(self.parts.read_folders(dropped), new, match, change_rows), None)], dropped)
