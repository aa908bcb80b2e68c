"""Commits over several partitions, and listings from file metadata."""

import glob
import os

import pytest
from helpers import d, rows
from pyspark.sql import functions as F

from tidemark.plans import partitions as pp
from tidemark.sources.versions import VersionedPartitions, file_listing

SCHEMA = "SchemaName string, ObjectName string, v long, PartitionValue timestamp_ntz"
COLS = ["SchemaName", "ObjectName", "PartitionValue"]


def months(n, obj="a+b c"):
    return [("s", obj, 10 * m + i, d(f"2020-{m:02d}-01")) for m in range(1, n + 1) for i in range(3)]


def dataset(spark, scratch, data):
    df = spark.createDataFrame(data, SCHEMA)
    stored = VersionedPartitions(spark, f"{scratch}/d", df.schema, COLS)
    split = F.col("PartitionValue") < F.lit("2020-03-01").cast("timestamp_ntz")
    stored.commit([(df.where(split), "zstd"), (df.where(~split), "snappy")])
    return stored


def test_listing_tells_value_codec_and_size_from_metadata_alone(spark, scratch):
    stored = dataset(spark, scratch, months(4) + months(2, "x"))
    files = stored.files()
    listed = pp.partition_listing(files, "PartitionValue").orderBy("ObjectName", "PartitionNumber").collect()
    assert [(r["ObjectName"], r["PartitionNumber"], r["PartitionValue"], r["CurrentCompression"]) for r in listed] == [
        ("a+b c", 1, d("2020-01-01"), "PAGE"), ("a+b c", 2, d("2020-02-01"), "PAGE"),
        ("a+b c", 3, d("2020-03-01"), "ROW"), ("a+b c", 4, d("2020-04-01"), "ROW"),
        ("x", 1, d("2020-01-01"), "PAGE"), ("x", 2, d("2020-02-01"), "PAGE"),
    ]
    on_disk = sum(os.path.getsize(f) for f in glob.glob(f"{scratch}/d/data/**/*.parquet", recursive=True))
    assert sum(r["Bytes"] for r in listed) == on_disk
    # one row per file is read, and neither a data column nor the content
    plan = file_listing(spark, f"{scratch}/d/data")._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in plan and "ReadSchema: struct<path:string,length:bigint>" in plan
    assert file_listing(spark, f"{scratch}/d/data").count() == len(glob.glob(f"{scratch}/d/data/**/*.parquet", recursive=True))


def test_a_partition_with_files_of_two_codecs_is_mixed(spark, scratch):
    stored = dataset(spark, scratch, months(1))
    stored.commit([(spark.createDataFrame(months(1), SCHEMA), "snappy")])
    (only,) = pp.partition_listing(stored.files(), "PartitionValue").collect()
    assert (only["CurrentCompression"], only["Files"] >= 2) == ("MIXED", True)
    assert stored.read().count() == 6


def merge(stored, spark, last):
    targets = spark.createDataFrame([(d("2020-01-01"), last), (d("2020-02-01"), last)], "PartitionValue timestamp_ntz, Neighbour timestamp_ntz")
    return pp.apply_merge(stored, targets, "PartitionValue")


def test_merge_moves_rows_in_one_commit_and_leaves_the_rest_alone(spark, scratch):
    stored = dataset(spark, scratch, months(4))
    kept = {f for f in stored.folders() if "2020-03" in f or "2020-04" in f}
    assert merge(stored, spark, d("2020-03-01")) == 2
    assert kept < set(stored.folders()) and len(stored.folders()) == 3
    want = [(*r[:3], max(r[3], d("2020-03-01"))) for r in months(4)]
    assert rows(stored.read(), "SchemaName", "ObjectName", "v", "PartitionValue") == sorted(want)


@pytest.mark.parametrize("step", ["_write", "_publish"])
def test_a_commit_stopped_half_way_shows_the_old_rows(spark, scratch, monkeypatch, step):
    stored = dataset(spark, scratch, months(4))
    before, folders = rows(stored.read()), stored.folders()
    real = getattr(VersionedPartitions, step)

    def stop(self, *a):
        if step == "_write":
            real(self, *a)  # the new files are there, the version is not
        raise OSError("stopped")

    monkeypatch.setattr(VersionedPartitions, step, stop)
    with pytest.raises(OSError):
        merge(stored, spark, d("2020-04-01"))
    other = VersionedPartitions(spark, stored.path, stored.schema, COLS)
    assert other.folders() == folders and rows(other.read()) == before and other.version() == 1
    monkeypatch.undo()
    merge(stored, spark, d("2020-04-01"))
    assert len(other.folders()) == 3 and other.read().count() == 12


def test_tiers_are_rewritten_in_one_commit(spark, scratch):
    stored = dataset(spark, scratch, months(6))
    before = rows(stored.read())
    listed = pp.partition_listing(stored.files(), "PartitionValue")
    tiers = pp.partition_tiers(listed, row_boundary=2).join(listed.select(*COLS, "PartitionNumber"), ["SchemaName", "ObjectName", "PartitionNumber"])
    assert pp.apply_tiers(stored, tiers, COLS) == 2
    now = pp.partition_listing(stored.files(), "PartitionValue").orderBy("PartitionNumber").collect()
    assert [r["CurrentCompression"] for r in now] == ["ROW", "PAGE", "PAGE", "PAGE", "ROW", "ROW"]
    assert rows(stored.read()) == before


def test_nothing_yet_and_nothing_left(spark, scratch):
    empty = VersionedPartitions(spark, f"{scratch}/e", spark.createDataFrame([], SCHEMA).schema, COLS)
    assert empty.read().isEmpty() and empty.files().isEmpty() and empty.version() == 0
    stored = dataset(spark, scratch, months(2))
    stored.commit([], stored.folders())
    assert stored.read().isEmpty() and stored.version() == 2
