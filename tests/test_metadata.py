"""Keys and computed columns in stored schemas; pairs found in the session catalog; one pair cancelled."""

import threading
import time

import pytest
from conftest import SF_SMALL
from helpers import FIRST_SCHEMA, TAG_SCHEMA, d
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixtures as fx
from tidemark.plans import control, pairs
from tidemark.sources.warehouse import FrameWarehouse, ParquetWarehouse, stored_specs
from tidemark.spec import TableSpec, described

STRUCT = T.StructType().add("v", "long").add("b", "string").add("a", "long", True, {"note": "x"}).add("twice", "long")
SPEC = TableSpec("T", ("a", "b"), {"twice": "v * 2"})


def test_descriptions_survive_in_the_schema():
    told = described(STRUCT, SPEC)
    assert TableSpec.of_schema("T", told) == SPEC
    assert told["a"].metadata["note"] == "x"
    again = described(told, TableSpec("T", ("b",)))  # what an older description said is gone
    assert TableSpec.of_schema("T", again) == TableSpec("T", ("b",))
    with pytest.raises(ValueError, match="no columns"):
        described(STRUCT, TableSpec("T", ("missing",)))
    with pytest.raises(ValueError, match="at least one key"):
        TableSpec.of_schema("T", STRUCT)


def test_stored_targets_tell_their_keys(spark, scratch):
    wh = ParquetWarehouse(spark, scratch, {("S", "T"): (SPEC, STRUCT)}, buckets=2)
    rows = spark.createDataFrame([(1, "x", 7, 2), (2, None, 8, 4)], "v long, b string, a long, twice long")
    wh._table("S", "T").append(rows)
    wh._table("S", "T").upsert(rows.limit(1), ["a", "b"], 1)  # a rewrite keeps them too
    found = stored_specs(spark, scratch, [("S", "T")])
    assert found[("S", "T")][0] == SPEC
    again = ParquetWarehouse(spark, scratch, found, buckets=2)
    want = [("S.T", "v", 1, None, None), ("S.T", "b", 2, 2, None), ("S.T", "a", 3, 1, None), ("S.T", "twice", 4, None, "v * 2")]
    assert sorted(map(tuple, again.table_specs().collect()), key=lambda r: r[2]) == want
    assert again.target("S", "T").count() == 2 and again.target("S", "T").columns == STRUCT.fieldNames()


def test_catalog_pairs_equal_the_registrys(spark, scratch):
    wh = fx.silver_warehouse(spark, SF_SMALL)
    rows = [tuple(r) for r in wh.registry().collect() if not r["object_name"].startswith("__")]
    names = sorted({r[0] for r in rows})
    for db in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{scratch}/{db}'")
    for db, name, kind in rows:
        what = f"VIEW `{db}`.`{name}` AS SELECT 1 AS k" if kind == "V" else f"TABLE `{db}`.`{name}` (k BIGINT) USING parquet"
        spark.sql(f"CREATE {what}")
    spark.range(1).createOrReplaceTempView("orders_latest")  # lies in no namespace
    try:
        registry = pairs.registry_from_catalog(spark)
        assert registry.count() == len(rows)
        for kind in fx.TAG_KINDS:
            got = pairs.discover_silver_pairs(registry, kind, any_case=True)
            want = pairs.discover_silver_pairs(wh.registry(), kind)
            low = [tuple(x.lower() if isinstance(x, str) else x for x in r) for r in want.collect()]
            assert low and sorted(map(tuple, got.collect())) == sorted(low)
    finally:
        spark.catalog.dropTempView("orders_latest")
        for db in names:
            spark.sql(f"DROP DATABASE `{db}` CASCADE")


def test_gold_pairs_in_any_case(spark):
    reg = spark.createDataFrame(
        [("live", "customer", "V"), ("dimension", "Customer", "U"), ("other", "customer", "U")],
        "schema_name string, object_name string, type string",
    )
    assert [r[1:5] for r in map(tuple, pairs.discover_gold_pairs(reg, True).collect())] == [
        ("live", "customer", "dimension", "Customer")
    ]
    assert pairs.discover_gold_pairs(reg).isEmpty()


def test_one_pair_is_cancelled_alone(spark):
    @F.udf("bigint")
    def slow(k):
        time.sleep(120)
        return k

    wh = FrameWarehouse(spark)
    rows = [(1, d("2020-01-01"), d("2021-01-01"), "I")]
    for s in ("A", "B", "C"):
        feed = spark.createDataFrame(rows, TAG_SCHEMA)
        wh.tables[(s, "T")] = feed.withColumn("LakeTimestamp", F.when(slow("k") > 0, F.col("LakeTimestamp"))) if s == "B" else feed
        wh.tables[(s + "_Tag", "T_Latest")] = spark.createDataFrame([], FIRST_SCHEMA)
        wh.specs[(s + "_Tag", "T_Latest")] = TableSpec("T_Latest", ("k",))
        wh.tables[(s + "_Tag", "__high_watermark")] = spark.createDataFrame([(d("2022-01-01"),)], "LakeTimestamp timestamp_ntz")
    done: list = []
    sc = spark.sparkContext
    run = threading.Thread(
        target=lambda: done.append(control.run_control("latest", wh, now=d("2023-01-01"), raise_on_failure=False, parallelism=3))
    )
    begun = time.monotonic()
    run.start()
    while run.is_alive() and time.monotonic() - begun < 100:
        time.sleep(1)
        control.cancel_pair(spark, "latest", ("B_Tag", "T_Latest"))
    run.join(150)
    assert time.monotonic() - begun < 100
    messages = {r.target: r.message for r in done[0].rows}
    assert messages["silver.A_Tag.T_Latest"] == messages["silver.C_Tag.T_Latest"] == ""
    assert "cancelled" in messages["silver.B_Tag.T_Latest"].lower()
    assert sc.getLocalProperty(control.POOL) is None and not sc.getJobTags()
