"""Parquet partitions with one commit for a change over several of them.

A commit writes its partitions into a folder of its own
(``<path>/data/commit=<id>/<col>=<value>/...``) and then adds one file to the
version list beside the data: the partition folders that make up the dataset
from now on. Readers resolve the newest version, so a change over several
partitions shows at once or not at all; a commit that stops half way leaves
folders that nobody lists. Folders of earlier versions stay until someone
removes them. One writer per dataset at a time.

The version list has a row per partition folder: metadata, read by the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import path_exists

COMMIT = "commit"


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """``path, length`` of every parquet file below ``path``, from file metadata alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(path).select("path", "length")


def value_in_path(col: str, path: Column | str = "path") -> Column:
    """The value of partition column ``col`` in a file's path, as text (null if there is none)."""
    raw = F.regexp_extract(path, f"/{col}=([^/]*)", 1)
    text = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(raw.isin("", "__HIVE_DEFAULT_PARTITION__"), F.lit(None)).otherwise(text)


class VersionedPartitions:
    """A parquet dataset partitioned by ``cols`` (fields of ``schema``)."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, cols: Sequence[str]) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.cols = tuple(cols)
        named = {f.name: f for f in schema.fields}
        last = [named[c] for c in self.cols]
        self.schema = T.StructType([f for f in schema.fields if f.name not in self.cols] + last)

    @property
    def _list(self) -> str:
        return f"{self.path}/versions"

    def folders(self) -> list[str]:
        """Partition folders of the newest version, relative to the data."""
        newest = self.version()
        rows = self._listed().where(F.col("version") == newest).select("folder").collect() if newest else []
        return sorted(r["folder"] for r in rows if r["folder"])

    def version(self) -> int:
        if not path_exists(self.spark, self._list):
            return 0
        return self._listed().agg(F.max("version").alias("v")).first()["v"]

    def _listed(self) -> DataFrame:
        return self.spark.read.schema("version long, folder string").parquet(self._list)

    def read_folders(self, folders: Sequence[str]) -> DataFrame:
        """Rows of some partition folders, as ``folders`` gives them."""
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType([*self.schema.fields, T.StructField(COMMIT, T.StringType())])
        paths = [f"{self.path}/data/{f}" for f in folders]
        return self.spark.read.schema(stored).option("basePath", f"{self.path}/data").parquet(*paths).drop(COMMIT)

    def read(self) -> DataFrame:
        """The newest version's rows."""
        return self.read_folders(self.folders())

    def files(self) -> DataFrame:
        """``path, length`` of the newest version's files."""
        folders = self.folders()
        if not folders:
            return self.spark.createDataFrame([], "path string, length long")
        at = self.spark.createDataFrame([(f,) for f in folders], "folder string")
        files = file_listing(self.spark, f"{self.path}/data").withColumn("folder", _folder(F.col("path")))
        return files.join(at, "folder", "left_semi").select("path", "length")

    def _write(self, rows: DataFrame, codec: str | None) -> list[str]:
        name = f"{COMMIT}={uuid.uuid4().hex}"
        options = {"compression": codec} if codec else {}
        dealt = rows.select(*self.schema.fieldNames()).hint("rebalance", *self.cols)
        dealt.write.options(**options).partitionBy(*self.cols).parquet(f"{self.path}/data/{name}")
        new = file_listing(self.spark, f"{self.path}/data/{name}").select(_folder(F.col("path")).alias("f")).distinct()
        return [r["f"] for r in new.collect()]

    def commit(self, parts: Sequence[tuple[DataFrame, str | None]], dropped: Sequence[str] = ()) -> int:
        """Add rows (each frame with its codec, None: the session's) and drop partition folders, in one step.

        ``dropped``: folders as ``folders`` gives them. A partition may lie in
        several folders; adding rows to it rewrites nothing.
        """
        stay = [f for f in self.folders() if f not in set(dropped)]
        for rows, codec in parts:
            stay += self._write(rows, codec)
        return self._publish(stay)

    def _publish(self, folders: Sequence[str]) -> int:
        version = self.version() + 1
        listed = [(version, f) for f in folders] or [(version, None)]
        rows = self.spark.createDataFrame(listed, "version long, folder string")
        rows.coalesce(1).write.mode("append").parquet(self._list)
        return version


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, f"/data/({COMMIT}=[^/]*(?:/[^/]+)*)/[^/]+$", 1)
