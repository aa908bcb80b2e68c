"""Keyed parquet tables: the state writer behind the loaders.

Plain parquet has no MERGE, so a keyed target is stored hash-partitioned by
its key into ``buckets`` directories (``_bucket=<n>``).  An upsert rewrites
only the buckets its change set touches:

1. the touched bucket numbers (at most ``buckets`` values, a fixed bound)
   are collected and become a partition filter, so the target scan lists
   and reads only those directories;
2. ``next = (stored rows not matched) UNION (changes)`` for those buckets;
3. the result is checkpointed into the session's shared checkpoint folder
   (``spark.checkpoint.dir``), so the write does not read the directories
   it replaces and a lost executor is recovered from the checkpoint, not by
   re-reading half-written files;
4. dynamic partition overwrite replaces exactly those buckets.

Choose ``buckets`` so one bucket holds roughly 128-512 MB.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tidemark.operators import merge

BUCKET = "_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a parquet dataset has been written at ``path``."""
    try:
        spark.read.parquet(path).schema  # noqa: B018 - lists files, reads no rows
        return True
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


class KeyedParquetTable:
    """A parquet directory hash-partitioned by its business key."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        schema: T.StructType,
        buckets: int = 16,
    ) -> None:
        self.spark = spark
        self.path = path
        self.keys = tuple(keys)
        self.schema = schema
        self.buckets = buckets
        self._pinned = False

    def _pin_buckets(self) -> None:
        """Store the bucket count at the first write; refuse another one later.

        A key's rows are looked for in the bucket of the stored count only.
        """
        if self._pinned:
            return
        layout = f"{self.path.rstrip('/')}.layout"
        if not path_exists(self.spark, layout):
            self.spark.createDataFrame([(self.buckets,)], "buckets int").coalesce(1).write.parquet(layout)
        stored = self.spark.read.parquet(layout).first()["buckets"]
        if stored != self.buckets:
            raise ValueError(f"{self.path} is stored in {stored} buckets, not {self.buckets}")
        self._pinned = True

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def read(self) -> DataFrame:
        """Current rows (without the bucket column); empty if never written."""
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self._stored_schema()).parquet(self.path).drop(BUCKET)

    def _stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType(), True)])

    def _with_bucket(self, df: DataFrame) -> DataFrame:
        # the columns' metadata (keys, computed columns) is written with the files' schema
        columns = [F.col(f.name).alias(f.name, metadata=f.metadata) if f.metadata else f.name for f in self.schema.fields]
        return df.select(*columns).withColumn(BUCKET, bucket_of(self.keys, self.buckets))

    def stored_fields(self) -> T.StructType:
        """The columns as the files describe them, metadata included (the declared ones if none is written)."""
        if not self.exists():
            return self.schema
        return T.StructType([f for f in self.spark.read.parquet(self.path).schema.fields if f.name != BUCKET])

    def touched_buckets(self, changes: DataFrame) -> list[int]:
        """Bucket numbers a change set touches (at most ``buckets`` values)."""
        self._pin_buckets()
        rows = changes.select(bucket_of(self.keys, self.buckets).alias(BUCKET)).distinct().collect()
        return sorted(r[0] for r in rows)

    def read_buckets(self, ids: list[int]) -> DataFrame:
        """Rows of the listed buckets only (a partition filter on the scan)."""
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return (
            self.spark.read.schema(self._stored_schema())
            .parquet(self.path)
            .where(F.col(BUCKET).isin(ids))
            .drop(BUCKET)
        )

    def append(self, rows: DataFrame) -> None:
        self._pin_buckets()
        self._add(self._with_bucket(rows))

    def _add(self, placed: DataFrame) -> None:
        # one file per bucket, or some of even size where a bucket is large
        placed.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(self.path)

    def upsert(self, changes: DataFrame, match: Sequence[str], change_rows: int | None = None) -> None:
        """Replace the rows matched on ``match`` and add new ones, bucket by bucket."""
        if not self.exists():
            self.append(changes)
            return
        touched = self.touched_buckets(changes)
        if not touched:
            return
        stored = (
            self.spark.read.schema(self._stored_schema())
            .parquet(self.path)
            .where(F.col(BUCKET).isin(touched))
            .drop(BUCKET)
        )
        nxt = self._with_bucket(merge.upsert(stored, changes, match, change_rows)).checkpoint()
        (
            nxt.hint("rebalance", BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(self.path)
        )

